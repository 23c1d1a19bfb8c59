"""The pipeline's stages against plain restatements, each on what its predecessor kept."""

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from gleaner.llm import language, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        rows = {r.doc_id: r for r in out.collect()}
        ids = sorted(kept)
        texts = [kept[i].text or "" for i in ids]
        if name == "language_id":
            model = language.fit(language.training_rows(docs))
            gone = language.predict_texts(model, texts)[3]
            want = {i for i, g in zip(ids, gone, strict=True) if not g}
        elif name == "toxicity":
            labels = toxicity.training_labels(spark.read.parquet(f"{SF}/labels.parquet"))
            model = toxicity.fit(docs, labels)
            table = model.table()
            s = toxicity.score_texts(model, table, table != 0, texts)
            want = {i for i, x in zip(ids, s, strict=True) if x < toxicity.THRESHOLD}
        else:
            words = {i: (kept[i].text or "").split() for i in ids}
            bags = {i: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in words.items() if w}
            root = {i: i for i in ids}

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            holders = defaultdict(list)
            for i, b in bags.items():
                for s in b:
                    holders[s].append(i)
            for pair in {(i, j) for m in holders.values() for i in m for j in m if i < j}:
                a, b = (bags[i] for i in pair)
                common = sum((a & b).values())
                if common >= 0.8 * (sum(a.values()) + sum(b.values()) - common):
                    x, y = (find(i) for i in pair)
                    root[max(x, y)] = min(x, y)
            want = {i for i in ids if find(i) == i}
        assert set(rows) == want, name
        assert all(rows[i] == kept[i] for i in rows)
        docs, kept = out, rows
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = defaultdict(int)
    for r in corpus_pipeline.STAGES[3][1](spark, docs, SF).collect():
        pieces[r.doc_id] += r.length
    assert dict(pieces) == {i: len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in kept.items()}


def test_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, None), (1, "", "en", None, None)], docs.schema)
    both = docs.limit(50).unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, both, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    rows = corpus_pipeline.STAGES[3][1](spark, both, SF).collect()
    assert sum(r.length == 1 and r.doc_tokens == 1 for r in rows) == 3
    assert np.isfinite([r.length for r in rows]).all()
