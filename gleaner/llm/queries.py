"""All queries of the subpackage, for the driver's registry."""

from . import bagminhash, blockmax, bpe, filteraudit, language, licenses, neighbours, orderminhash, packing, repair, sharding, simhash, toxicity

MODULES = (neighbours, language, bpe, orderminhash, bagminhash, sharding, packing, toxicity, repair, licenses, simhash, filteraudit, blockmax)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL = {k: s for m in MODULES for k, s in getattr(m, "ORACLE_SQL", {}).items()}
