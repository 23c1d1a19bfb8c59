"""Operator 4 [native]: Order MinHash fingerprints of documents, built-in functions only.

A text is the sequence of its words (between white space; each very long word, as in scripts without spaces, gives its
characters).  Every k-mer, a run of K words, is numbered by its occurrence: the first gets the hash of
the k-mer, the j-th repetition a hash of (k-mer, j).  The hash space is cut into BINS equal parts, each a repetition of
the sketch: of the numbered k-mers whose hash falls into a part the L smallest are kept, put back into text order and
hashed as a tuple.  Two texts agree in a part if they keep the same k-mers in the same order, so the likeness, the share
of agreeing parts among those that either text fills, follows edit distance, not only overlap.

A numbered k-mer is one long: 40 bits of hash above 24 bits of position, so sorting longs selects and keeps places.
Everything is done inside a row; only the neighbouring document's text moves, in one exchange by ranges of doc_id.

Defined results.  A null text is empty; an empty fingerprint is '' and is like another empty one (1) and unlike all
others (0).  Equal texts have equal fingerprints.  The next document is by ascending doc_id, nulls first, equal ids by
text; the last row's is the first row's; a single row is its own next.  Repeated rows keep one row each.  Extra columns
are not read.  Beyond 2^24 words positions wrap, which may change the order inside a tuple but stays deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import parts, range_of, splitters, with_text

BINS_BITS, L, K = 6, 2, 3
POSITION_BITS = 24
#: Characters above which a word is taken character by character.
LONG_WORDS = 24
HASH_MASK, POSITION_MASK = -(1 << POSITION_BITS), (1 << POSITION_BITS) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - BINS_BITS)


def tokens(text: Column) -> Column:
    by_word = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    is_long = lambda w: F.char_length(w) > LONG_WORDS
    cut = lambda words: F.flatten(F.transform(words, lambda w: F.when(is_long(w), F.split(w, "")).otherwise(F.array(w))))
    # Each word is judged by itself: an edit elsewhere in the text does not change how it is cut.
    return let(by_word, lambda words: F.when(F.exists(words, is_long), cut(words)).otherwise(words))


def kmers(words: Column, k: int) -> Column:
    """Sorted longs of hash and position; the last k-mers of a text are shorter."""

    def one(w: Column, i: Column) -> Column:
        return F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]).bitwiseAND(F.lit(HASH_MASK)).bitwiseOR(i.bitwiseAND(F.lit(POSITION_MASK)).cast("long"))

    return F.sort_array(F.transform(words, one))


def smallest(found: Column, l: int) -> Column:
    """Of a sorted array, the l smallest of each bin."""
    return F.filter(found, lambda x, i: (i < l) | (_bin(x) != _bin(F.get(found, i - l))))


def repeats(found: Column) -> Column:
    """Sorted longs of the second and later occurrences, hashed anew with their number."""
    n = F.size(found)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (_hash(F.get(found, i)) != _hash(F.get(found, i - 1))))

    def numbered(first: Column) -> Column:
        number = F.flatten(F.transform(first, lambda a, j: F.sequence(F.lit(0), F.coalesce(F.get(first, j + 1), n) - a - 1)))
        pairs = F.filter(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: F.get(found, p["i"] - 1).isNotNull() & (_hash(p["x"]) == _hash(F.get(found, p["i"] - 1))))
        fresh = let(number, lambda c: F.transform(pairs, lambda p: F.xxhash64(_hash(p["x"]), F.get(c, p["i"])).bitwiseAND(F.lit(HASH_MASK)).bitwiseOR(p["x"].bitwiseAND(F.lit(POSITION_MASK)))))
        return F.sort_array(fresh)

    return let(starts, numbered)


def sketch(text: Column, k: int = K, l: int = L) -> Column:
    """The fingerprint as an array: for each filled bin, the bin above 32 bits of the tuple's hash."""

    def chosen(found: Column) -> Column:
        def merged(first: Column) -> Column:
            all_ = F.sort_array(F.concat(smallest(first, l), let(repeats(found), lambda r: smallest(r, l))))
            return F.when(F.size(first) == F.size(found), smallest(first, l)).otherwise(let(all_, lambda a: smallest(a, l)))

        return let(F.filter(found, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(found, i - 1)))), merged)

    def tuples(kept: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            own = F.filter(F.slice(kept, i + 1, l), lambda y: _bin(y) == _bin(x))
            in_order = F.sort_array(F.transform(own, lambda y: F.struct(y.bitwiseAND(F.lit(POSITION_MASK)).alias("p"), _hash(y).alias("h"))))
            value = F.xxhash64(F.transform(in_order, lambda y: y["h"])).bitwiseAND(F.lit(0xFFFFFFFF))
            starts = (i == 0) | (_bin(x) != _bin(F.get(kept, i - 1)))
            return F.when(starts, F.shiftleft((_bin(x) + (1 << (BINS_BITS - 1))).cast("long"), 32).bitwiseOR(value))

        return F.filter(F.transform(kept, one), lambda v: v.isNotNull())

    return let(tokens(text), lambda w: let(kmers(w, k), lambda s: let(chosen(s), tuples)))


def as_text(fingerprint: Column) -> Column:
    """Ten hexadecimal digits per filled bin."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.lower(F.hex(v)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Agreeing bins over bins that either fingerprint fills, 0 to 1."""
    bins = F.size(F.array_union(F.transform(a, lambda v: F.shiftright(v, 32)), F.transform(b, lambda v: F.shiftright(v, 32))))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, l: int = L) -> DataFrame:
    """(doc_id, text, sketch) of every row; no shuffle."""
    docs = with_text(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return docs.withColumn("sketch", sketch(F.col("text"), k, l))


def with_next(df: DataFrame, key: Column, carried: list[str], prefix: str = "next_") -> DataFrame:
    """df with the carried columns of the next row by key, the first row's for the last.

    Rows are dealt to ranges of the key; the first rows of each range also go to the range before, as its end.  Every
    range is sorted on its own, so no task holds more than a range.
    """
    keyed = df.withColumn("__key", key)
    cuts = splitters(keyed.select("__key"), "__key", 3 * parts(df.sparkSession))
    n = max(1, len(cuts))
    keyed = keyed.withColumn("__range", range_of(F.col("__key"), cuts))
    # The splitters are keys that occur: a row with one is the first of its range.
    first = F.col("__key").isin(cuts) if len(cuts) <= 64 else range_of(F.col("__key") - 1, cuts) != F.col("__range")
    first = F.when(F.col("__key") == (min(cuts) if cuts else 0), F.lit(True)).otherwise(first)
    before = F.struct(F.pmod(F.col("__range") - 1, F.lit(n)).alias("r"), F.lit(1).alias("halo"))
    own = F.struct(F.col("__range").alias("r"), F.lit(0).alias("halo"))
    dealt = keyed.withColumn("__to", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
    # Plain columns, and all leads in one step: one exchange and one sort serve every carried column.
    dealt = dealt.select(*df.columns, "__key", F.col("__to.r").alias("__range"), F.col("__to.halo").alias("__halo"))
    order = Window.partitionBy("__range").orderBy("__halo", "__key", *carried[:1])
    leads = dealt.select("*", *[F.lead(c).over(order).alias(prefix + c) for c in carried])
    return leads.where("__halo = 0").drop("__key", "__range", "__halo")


def op4_order_minhash(spark, sf_dir: str) -> DataFrame:
    docs = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    low = F.lit(-(1 << 63))
    both = with_next(docs, F.coalesce(F.col("doc_id").cast("long"), low), ["text", "sketch"])
    half = "(char_length(text) div 2)"
    both = both.withColumn("edited", F.expr(f"concat(substring(text, 1, cast(char_length(text) - {half} as int)), substring(next_text, 1, cast({half} as int)))"))
    both = both.withColumn("edited_sketch", sketch(F.col("edited")))
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


QUERIES = {"op4_order_minhash": op4_order_minhash}
