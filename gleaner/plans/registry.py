"""Queries of the reference operators on the driver's tables, each with its SQL where SQL can state it.

The tables hold no notices, so every query binds an operator to their columns: page URLs are candidate URLs, document
texts are page texts, events are lifecycle notices of the user as buyer, orders are financings of the customer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clock, extract, ids, text, urls
from ..functions import lexicon as lx
from ..operators import aliases, claims, enrich, followup, items, report, resolve, select, signals, state, verify

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
#: Terms that occur in the synthetic texts, in the place of the domain lists.
SUBJECTS = ("license", "permission", "street", "phone")
ACTIONS = ("released", "licensed", "rights", "call")
CLASSES = (("legal", ("license", "rights reserved")), ("contact", ("phone", "@", "street")), ("romance", (" la ", " le ", " los ")), ("german", (" der ", " und ")))
GRADES = (("example.com", "A"), ("example.org", "B"), ("blog.ththly.example.org", "A"))
STAGE_OF = {"view": "intention", "click": "tender", "signup": "candidate", "purchase": "award", "error": "failed"}


def now() -> Column:
    return F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day_of(date: str) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("stage", lx.mapped(F.col("event_type"), STAGE_OF, F.lit("other")))


_STAGE_SQL = "CASE event_type WHEN 'view' THEN 'intention' WHEN 'click' THEN 'tender' WHEN 'signup' THEN 'candidate' WHEN 'purchase' THEN 'award' WHEN 'error' THEN 'failed' ELSE 'other' END"
_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_KEPT_SQL = r"list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: NOT (lower(string_split(p, '=')[1]) IN ('spm', 'from', 'source') OR starts_with(lower(string_split(p, '=')[1]), 'utm_')))"
_NURL_SQL = rf"""lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) || '://' || {_HOST_SQL} || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)
  || CASE WHEN array_to_string({_KEPT_SQL}, '&') = '' THEN '' ELSE '?' || array_to_string(CASE WHEN len(list_filter({_KEPT_SQL}, lambda p: NOT regexp_matches(p, '^[^=]+=.+$'))) = 0 THEN list_sort({_KEPT_SQL}) ELSE {_KEPT_SQL} END, '&') END"""


# --------------------------------------------------------------------- URLs, texts, identities
@query(f"SELECT page_id, {_NURL_SQL} AS normalized FROM pages")
def url_normalize(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normalized"))


@query(f"SELECT page_id, normalized FROM (SELECT page_id, {_NURL_SQL} AS normalized, row_number() OVER (PARTITION BY {_NURL_SQL} ORDER BY page_id) AS n FROM pages) WHERE n = 1")
def url_dedupe_first(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normalized"))
    return select.first_by(pages, F.col("normalized"), "page_id")


@query(f"""WITH h AS (SELECT page_id, {_HOST_SQL} AS host FROM pages), r(domain, grade) AS (VALUES {", ".join(f"('{d}', '{g}')" for d, g in GRADES)}),
 m AS (SELECT page_id, host, domain, grade, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC) AS n FROM h LEFT JOIN r ON host = domain OR ends_with(host, '.' || domain))
 SELECT page_id, host, domain, coalesce(grade, 'C') AS grade FROM m WHERE n = 1""")
def url_host_grade(spark, sf):
    registry = spark.createDataFrame(list(GRADES), "domain string, grade string")
    return verify.graded(table(spark, sf, "pages").select("page_id", "url"), "url", registry).select("page_id", "host", "domain", "grade")


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[\p{P}\p{S}]', '', 'g'), '\s+', ' ', 'g')) AS normalized FROM documents")
def text_normalize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize(F.col("text")).alias("normalized"))


@query("SELECT doc_id, sha256('{\"doc_id\":' || doc_id || ',\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}') AS version FROM documents")
def canonical_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.canonical_hash(source=F.col("source"), lang=F.col("lang"), doc_id=F.col("doc_id")).alias("version"))


@query("""WITH d AS (SELECT event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('gleaner:event:' || event_id)) AS h FROM events)
 SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS stable_id FROM d""")
def stable_uuid(spark, sf):
    return table(spark, sf, "events").select("event_id", ids.event_id(F.col("event_id").cast("string")).alias("stable_id"))


@query("""SELECT name, regexp_replace(regexp_replace(replace(lower(regexp_replace(name, '[#]', '', 'g')), ' ', ''), 'ltd$', ''), '^(customer|supplier)(...)', '\\2') AS identity
 FROM (SELECT c_name AS name FROM customer UNION ALL SELECT s_name || ' Ltd.' AS name FROM supplier) t""".replace("'[#]'", "'[#.]'"))
def org_identity(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("name")).unionAll(table(spark, sf, "supplier").select(F.concat("s_name", F.lit(" Ltd.")).alias("name")))
    return names.select("name", text.organization(F.col("name"), ("ltd",), ("customer", "supplier")).alias("identity"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(CASE doc_id % 4 WHEN 0 THEN ['prea+'] WHEN 1 THEN ['a', 'b+'] WHEN 2 THEN ['天使'] ELSE [] END)), ',') AS rounds FROM documents""")
def round_identities(spark, sf):
    k = F.col("doc_id") % 4
    label = F.when(k == 0, "Pre-A+ 轮").when(k == 1, "B+轮和A轮").when(k == 2, "天使轮").otherwise("其它")
    return table(spark, sf, "documents").select("doc_id", F.array_join(text.rounds(label), ",").alias("rounds"))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) * 1e8 WHEN o_orderkey % 3 = 1 THEN floor(o_totalprice) * 1e4 ELSE floor(o_totalprice) END AS DOUBLE) AS amount FROM orders")
def amount_parse(spark, sf):
    k = F.col("o_orderkey") % 3
    said = F.concat(F.lit("融资约"), F.floor("o_totalprice").cast("string"), F.when(k == 0, "亿元").when(k == 1, "万元").otherwise("元"))
    return table(spark, sf, "orders").select("o_orderkey", text.amount_cny(said).alias("amount"))


@query("SELECT p_partkey, CAST(2000 + p_size AS INTEGER) AS year, CAST(p_partkey % 7 AS VARCHAR) AS batch, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS lot FROM part")
def title_markers(spark, sf):
    title = F.concat((F.col("p_size") + 2000).cast("string"), F.lit("年"), F.col("p_name"), F.lit("第0"), (F.col("p_partkey") % 7).cast("string"), F.lit("批"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" 标段-"), F.col("p_size").cast("string"))).otherwise(""))
    return table(spark, sf, "part").select("p_partkey", text.markers(title).alias("m")).select("p_partkey", "m.year", "m.batch", "m.lot")


# --------------------------------------------------------------------- gates, ranking, top-k
@query(r"SELECT page_id FROM pages WHERE regexp_matches(url, '^(?i:https?)://[^/?#:]+') AND regexp_matches(html, '\S')")
def shape_filter(spark, sf):
    return table(spark, sf, "pages").where(urls.usable_shape(F.col("url"), F.col("html"), F.col("url"))).select("page_id")


def _lexicon_sql(terms) -> str:
    return " + ".join(f"contains(t, '{x}')::INT" for x in terms)


_MATCHED_SQL = f"array_to_string(list_filter([{', '.join(repr(x) for x in (*SUBJECTS, *ACTIONS))}], lambda x: contains(t, x)), ',')"
_SAID_SQL = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


@query(f"""SELECT doc_id, subject_hits + action_hits AS score, matched FROM (SELECT doc_id, {_lexicon_sql(SUBJECTS)} AS subject_hits, {_lexicon_sql(ACTIONS)} AS action_hits, {_MATCHED_SQL} AS matched
 FROM (SELECT doc_id, {_SAID_SQL} AS t FROM documents)) WHERE subject_hits > 0 AND action_hits > 0""")
def lexicon_relevance(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", text.squeezed(F.col("text")).alias("t"))
    scored = docs.select("doc_id", lx.hits(F.col("t"), SUBJECTS).alias("s"), lx.hits(F.col("t"), ACTIONS).alias("a"), F.array_join(lx.matched(F.col("t"), (*SUBJECTS, *ACTIONS)), ",").alias("matched"))
    return scored.where("s > 0 and a > 0").select("doc_id", (F.col("s") + F.col("a")).alias("score"), "matched")


@query("SELECT doc_id, CASE " + " ".join(f"WHEN {' OR '.join(f'''contains(lower(text), '{x}')''' for x in terms)} THEN '{name}'" for name, terms in CLASSES) + " ELSE 'unknown' END AS class FROM documents")
def ordered_classifier(spark, sf):
    return table(spark, sf, "documents").select("doc_id", lx.first_label(F.lower("text"), CLASSES, "unknown").alias("class"))


_AGE_SQL = f"date_diff('microsecond', ts, {NOW_SQL})"
_BUCKET_SQL = f"CASE WHEN ts IS NULL THEN 'unknown' WHEN {_AGE_SQL} < -86400000000 OR {_AGE_SQL} > 1814400000000 THEN NULL WHEN {_AGE_SQL} <= 604800000000 THEN 'recent' ELSE 'fallback' END"


@query(f"SELECT event_id, {_BUCKET_SQL} AS bucket FROM events")
def recency_bucket(spark, sf):
    return table(spark, sf, "events").select("event_id", clock.bucket(F.col("ts"), now(), 7, 21).alias("bucket"))


@query(f"SELECT event_id, CASE WHEN d < 0 THEN 'future' WHEN d <= 7 THEN 'last 7 days' WHEN d <= 30 THEN '8-30 days' ELSE 'older' END AS label FROM (SELECT event_id, CAST(floor({_AGE_SQL} / 86400000000.0) AS BIGINT) AS d FROM events)")
def pending_label(spark, sf):
    return table(spark, sf, "events").select("event_id", clock.age_label(F.col("ts"), now()).alias("label"))


@query("SELECT doc_id, place FROM (SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN starts_with(source, 'src1') THEN 0 ELSE 1 END, n_chars DESC NULLS LAST, doc_id) AS place FROM documents) WHERE place <= 50")
def rank_candidates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("source").startswith("src1"), 0).otherwise(1).alias("tier"), F.col("n_chars"))
    top = docs.orderBy("tier", F.desc_nulls_last("n_chars"), "doc_id").limit(50)  # a top-k report
    return top.select("doc_id", F.row_number().over(Window.orderBy("tier", F.desc_nulls_last("n_chars"), "doc_id")).cast("long").alias("place"))


@query(f"""WITH b AS (SELECT event_id, ts, value, {_BUCKET_SQL} AS bucket FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY value DESC, event_id) AS rk FROM b WHERE bucket IS NOT NULL),
 n AS (SELECT least(count(*) FILTER (bucket = 'recent'), 20) AS recent, least(count(*) FILTER (bucket = 'fallback'), 20) AS older FROM b),
 m AS (SELECT recent, greatest(12 - recent, 0) AS room, greatest(12 - recent - least(older, greatest(12 - recent, 0)), 0) AS undated FROM n)
 SELECT event_id, bucket, row_number() OVER (ORDER BY CASE bucket WHEN 'recent' THEN 0 WHEN 'fallback' THEN 1 ELSE 2 END, rk) AS place FROM r, m
 WHERE (bucket = 'recent' AND rk <= 20) OR (bucket = 'fallback' AND rk <= room) OR (bucket = 'unknown' AND rk <= least(undated, 2))""")
def topk_backfill(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", clock.bucket(F.col("ts"), now(), 7, 21).alias("bucket"))
    return select.backfill(events, [F.desc("value"), F.asc("event_id")], minimum=12, maximum=20).select("event_id", "bucket", "place")


@query("""WITH c AS (SELECT event_id, value, event_type, row_number() OVER (PARTITION BY CASE WHEN event_type IN ('purchase', 'click', 'view') THEN event_type END ORDER BY value DESC, event_id) AS rk FROM events),
 p AS (SELECT *, CASE WHEN event_type = 'purchase' AND rk <= 3 THEN 0 WHEN event_type = 'click' AND rk <= 2 THEN 1 WHEN event_type = 'view' AND rk <= 2 THEN 2 ELSE 3 END AS first FROM c)
 SELECT event_id, event_type, place FROM (SELECT event_id, event_type, row_number() OVER (ORDER BY first, value DESC, event_id) AS place FROM p) WHERE place <= 15""")
def quota_topk(spark, sf):
    klass = F.when(F.col("event_type").isin("purchase", "click", "view"), F.col("event_type"))
    return select.quota(table(spark, sf, "events").select("event_id", "event_type", "value"), [F.desc("value"), F.asc("event_id")], klass, {"purchase": 3, "click": 2, "view": 2}, 15).select("event_id", "event_type", "place")


#: A leader's group ends fourteen days before it, exactly, as the floor is taken before the sign is dropped.
@query("""WITH RECURSIVE l AS (SELECT user_id, event_type, arg_min(event_id, struct_pack(a := -epoch_us(ts), b := event_id)) AS leader, max(ts) AS ts FROM events GROUP BY 1, 2
 UNION ALL SELECT e.user_id, e.event_type, arg_min(e.event_id, struct_pack(a := -epoch_us(e.ts), b := e.event_id)), max(e.ts) FROM l JOIN events e ON e.user_id = l.user_id AND e.event_type = l.event_type AND e.ts < l.ts - INTERVAL 14 DAY GROUP BY 1, 2)
 SELECT leader, count(*) AS n FROM l JOIN events e ON e.user_id = l.user_id AND e.event_type = l.event_type AND e.ts <= l.ts AND e.ts >= l.ts - INTERVAL 14 DAY GROUP BY 1""")
def event_dedupe_greedy(spark, sf):
    """Greedy event equality: notices of one buyer and kind within fourteen floored days are one event."""
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("pos"), F.lit(lx.FINANCING).alias("category"), F.col("user_id").cast("string").alias("company"), F.array("event_type").alias("rounds"),
        F.lit(None).cast("string").alias("code"), F.col("event_type").alias("stage"), F.lit("").alias("title_key"), F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), "ts").alias("published_us"), (-F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), "ts")).alias("newest"),
    )
    blocks = select.group_events(e.withColumn("company", F.concat_ws("/", "company", "stage")), "pos", ["newest"])
    return blocks.groupBy("leader").agg(F.count("*").alias("n"))


_PATH = r"^[^:/?#]+://[^/?#]*/([a-z]+/[0-9]+)"


@query(f"""WITH h AS (SELECT page_id, {_HOST_SQL} AS host, regexp_extract(url, '{_PATH}', 1) AS path FROM pages), p AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY page_id) = 1 AS leads FROM h WHERE path <> ''),
 f AS (SELECT *, row_number() OVER (PARTITION BY path, host ORDER BY page_id) AS k FROM p WHERE NOT leads),
 r AS (SELECT l.page_id AS place, f.page_id, row_number() OVER (PARTITION BY f.path ORDER BY CASE WHEN f.k = 1 AND f.host <> l.host AND f.host <> '' THEN 0 ELSE 1 END, f.page_id) AS extra FROM f JOIN p l ON l.path = f.path AND l.leads)
 SELECT place, page_id, extra FROM r WHERE extra <= 2""")
def corroborating_topk(spark, sf):
    """Pages of one path are reports of one matter: the first of each leads, two others at most corroborate it."""
    pages = table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", _PATH, 1).alias("path")).where("path <> ''")
    first = pages.groupBy("path").agg(F.min("page_id").alias("place"), F.min_by("url", "page_id").alias("primary_url"))
    others = pages.join(first, "path").where("page_id <> place").withColumn("rank_pos", F.col("page_id"))
    return select.corroborating(others).select("place", "page_id", "extra")


# --------------------------------------------------------------------- verification
@query("SELECT doc_id, item_id FROM documents d JOIN (SELECT item_id, text AS quote FROM benchmark WHERE trim(text) <> '') b ON contains(d.text, b.quote)")
def evidence_grounding(spark, sf):
    """Documents in which a whole benchmark text stands."""
    quotes = table(spark, sf, "benchmark").where(F.trim("text") != "").select("item_id", F.col("text").alias("quote"))
    return verify.groundings(table(spark, sf, "documents").select("doc_id", "text"), quotes, "doc_id", "text", "item_id", "quote")


@query("""SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'rejected' WHEN lang IS NULL OR text = '' THEN 'pending' WHEN n_chars <> length(text) THEN 'pending' WHEN l.toxic = 1 THEN 'pending' WHEN l.quality = 0 THEN 'pending' ELSE 'verified' END AS status,
 CASE WHEN l.quality IS NULL THEN 'out_of_scope' WHEN lang IS NULL OR text = '' THEN 'missing_required_fields' WHEN n_chars <> length(text) THEN 'source_mismatch' WHEN l.toxic = 1 THEN 'evidence_not_grounded' WHEN l.quality = 0 THEN 'requires_grade_a' ELSE 'verified' END AS reason
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def decision_cascade(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rules = [
        (F.col("quality").isNull(), "rejected", "out_of_scope"), (F.col("lang").isNull() | (F.col("text") == ""), "pending", "missing_required_fields"),
        (F.col("n_chars") != F.char_length("text"), "pending", "source_mismatch"), (F.col("toxic") == 1, "pending", "evidence_not_grounded"), (F.col("quality") == 0, "pending", "requires_grade_a"),
    ]
    status, reason = verify.cascade(rules)
    return rows.select("doc_id", status.alias("status"), reason.alias("reason"))


@query("""WITH r AS (SELECT d.doc_id AS pos, lang, quality, source AS domain, n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
 SELECT a.pos, min(b.pos) AS corroborator FROM r a LEFT JOIN r b ON a.lang = b.lang AND a.quality = b.quality AND a.domain <> b.domain AND NOT ends_with(a.domain, '.' || b.domain) AND NOT ends_with(b.domain, '.' || a.domain) AND a.n_chars <> b.n_chars GROUP BY a.pos""")
def corroboration_self_join(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("pos"), "lang", "quality", F.col("source").alias("domain"), F.col("n_chars").alias("content"))
    return verify.corroboration(rows, ["lang", "quality"], "pos", "domain", "content")


@query("""WITH l AS (SELECT l_orderkey, max(l_shipdate) AS bid, min(l_shipdate) AS opening FROM lineitem GROUP BY 1)
 SELECT o_orderkey, CAST(o_orderdate AS DATE) < DATE '1998-06-01' AND bid < TIMESTAMP '1998-06-01 00:00:00' AS overdue, CASE WHEN opening >= TIMESTAMP '1998-06-01 00:00:00' THEN opening WHEN bid >= TIMESTAMP '1998-06-01 00:00:00' THEN bid END AS next_deadline
 FROM orders JOIN l ON o_orderkey = l_orderkey""")
def deadline_status(spark, sf):
    at = F.expr("TIMESTAMP_NTZ '1998-06-01 00:00:00'")
    dates = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("bid"), F.min("l_shipdate").alias("opening"))
    rows = table(spark, sf, "orders").join(dates, F.col("o_orderkey") == F.col("l_orderkey"))
    deadlines = F.create_map(F.lit("registration"), "o_orderdate", F.lit("bid"), "bid")
    kinds = F.create_map(F.lit("registration"), F.lit("date"), F.lit("bid"), F.lit("minute"))
    open_ = F.array_min(F.filter(F.array("bid", "opening"), lambda d: d >= at))
    return rows.select("o_orderkey", verify.overdue(deadlines, kinds, kinds, at).alias("overdue"), open_.alias("next_deadline"))


# --------------------------------------------------------------------- resolution and state
@query()
def project_match(spark, sf):
    """Events of a buyer become projects by code, markers and title similarity, one after another."""
    e = staged(spark, sf)
    code = F.concat(F.lit("XW"), F.col("user_id").cast("string"), F.dayofmonth("ts").cast("string"))
    rows = e.select(
        F.col("event_id").alias("pos"), F.col("user_id").cast("string").alias("buyer"), F.lit("c").alias("category"), F.concat(F.lit("project "), "event_type", F.lit(" "), F.dayofmonth("ts").cast("string")).alias("title"),
        F.when(F.col("event_id") % 3 == 0, F.array(code)).otherwise(F.array().cast("array<string>")).alias("codes"), F.array(code).alias("base_codes"), (F.col("stage") == "failed").alias("rebid"),
        F.year("ts").alias("year"), F.lit(False).alias("year_stated"), F.lit(None).cast("string").alias("batch"), F.lit(None).cast("string").alias("lot"), F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), "ts").alias("us"),
    )
    return resolve.fold_projects(rows)


@query(f"""WITH e AS (SELECT *, {_STAGE_SQL} AS stage FROM events), s AS (SELECT *, CASE stage WHEN 'intention' THEN 'upcoming' WHEN 'tender' THEN 'open' WHEN 'candidate' THEN 'evaluating' WHEN 'award' THEN 'awarded' WHEN 'failed' THEN 'failed' ELSE 'open' END AS st FROM e)
 SELECT user_id, count(*) AS n_events, min(ts) AS first_at, max(ts) AS latest_at, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS latest_event, arg_max(stage, struct_pack(a := ts, b := event_id)) AS latest_stage,
 arg_max(st, struct_pack(a := ts, b := event_id)) AS status, arg_max(stage <> 'award', struct_pack(a := ts, b := event_id)) AS recheck FROM s GROUP BY user_id""")
def project_rollup(spark, sf):
    return state.rollup(staged(spark, sf), "user_id", "ts", "event_id", "stage")


@query(f"SELECT user_id, array_to_string(list({_STAGE_SQL} ORDER BY ts, event_id), ' → ') AS chain, count(*) AS n_events FROM events GROUP BY user_id")
def event_chain(spark, sf):
    return state.chain(staged(spark, sf), "user_id", "ts", "event_id", "stage")


_PRINT_SQL = """sha256('{"amount_cny":"' || CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR) || '","announced_at":"' || strftime(o_orderdate, '%Y-%m-%d') || '","company":"' || (o_custkey % 50) || '","financing_subtype":"","investors":["' || o_orderstatus || '"],"round_name":"' || o_orderpriority || '"}')"""


def _printed(spark, sf) -> DataFrame:
    amount = F.floor(F.col("o_totalprice") / 100000).cast("string")
    print_ = ids.financing_fingerprint(F.col("o_orderdate"), amount, (F.col("o_custkey") % 50).cast("string"), F.array("o_orderstatus"), F.col("o_orderpriority"), F.lit(None).cast("string"))
    return table(spark, sf, "orders").withColumn("fingerprint", print_)


@query(f"SELECT fingerprint, min(o_orderkey) AS first_order, count(*) AS n FROM (SELECT o_orderkey, {_PRINT_SQL} AS fingerprint FROM orders) GROUP BY fingerprint")
def financing_fingerprint(spark, sf):
    return _printed(spark, sf).groupBy("fingerprint").agg(F.min("o_orderkey").alias("first_order"), F.count("*").alias("n"))


_ROUND_OF = {"1-URGENT": "A轮", "2-HIGH": "A轮、B轮", "3-MEDIUM": "B轮", "5-LOW": "Pre-A轮"}
_LEAD_SQL = "{'pos': pos, 'day': day, 'rounds': rounds, 'kind': kind, 'fp': fp, 'terms': terms, 'urls': urls}"


@query(f"""WITH RECURSIVE o AS (SELECT o_orderkey AS pos, o_custkey AS company, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) % 90 AS INTEGER) AS day, CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice / 100000) END AS amount,
  o_orderstatus AS st, o_orderpriority AS pr, ['x/' || o_orderkey % 4, 'y/' || CAST(floor(o_totalprice) AS BIGINT) % 6] AS urls FROM orders),
 r AS (SELECT pos, company, day, amount, urls, CASE pr WHEN '1-URGENT' THEN ['a'] WHEN '2-HIGH' THEN ['a', 'b'] WHEN '3-MEDIUM' THEN ['b'] WHEN '5-LOW' THEN ['prea'] ELSE [] END AS rounds, CASE WHEN pr = '4-NOT SPECIFIED' THEN 'strategic' ELSE 'round_equity' END AS kind,
  concat_ws('/', day, coalesce(amount, -1), st, pr) AS fp, concat_ws('/', pr, coalesce(amount, -1), st) AS terms, row_number() OVER (PARTITION BY company ORDER BY pos) AS k FROM o),
 s AS (SELECT company, k, pos, pos AS financing, [{_LEAD_SQL}] AS ls FROM r WHERE k = 1
  UNION ALL SELECT company, k, pos, coalesce(f, pos), CASE WHEN f IS NULL THEN list_append(ls, {_LEAD_SQL}) ELSE list_transform(ls, lambda l: CASE WHEN l.pos = f THEN {{'pos': l.pos, 'day': l.day, 'rounds': l.rounds, 'kind': l.kind, 'fp': l.fp, 'terms': l.terms, 'urls': list_concat(l.urls, urls)}} ELSE l END) END
  FROM (SELECT *, coalesce(x[1].pos, CASE WHEN len(y) = 1 THEN y[1].pos END, CASE WHEN len(z) = 1 THEN z[1].pos END) AS f FROM (SELECT r.*, s.ls, list_filter(s.ls, lambda l: l.fp = r.fp) AS x, list_filter(s.ls, lambda l: l.terms = r.terms AND abs(l.day - r.day) <= 7) AS z,
   list_filter(s.ls, lambda l: list_has_any(l.urls, r.urls) AND l.kind = r.kind AND abs(l.day - r.day) <= 45 AND len(l.rounds) > 0 AND len(r.rounds) > 0 AND (list_has_all(l.rounds, r.rounds) OR list_has_all(r.rounds, l.rounds))) AS y FROM s JOIN r ON r.company = s.company AND r.k = s.k + 1)))
 SELECT financing, count(*) AS reports, min(pos) AS first_report, max(day) - min(day) AS days, max(amount) AS most FROM s JOIN (SELECT pos, day, amount FROM r) USING (pos) GROUP BY 1""")
def financing_merge(spark, sf):
    """Orders of a customer as reports of its financings, merged in order by fingerprint, shared source or terms."""
    day = (F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")) % 90).cast("int")
    amount = F.when(F.col("o_orderkey") % 5 != 0, F.floor(F.col("o_totalprice") / 100000).cast("double"))
    reports = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), F.concat(F.lit("客户"), F.col("o_custkey").cast("string")).alias("company"), lx.mapped(F.col("o_orderpriority"), _ROUND_OF, F.lit(None).cast("string")).alias("round_name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("strategic")).alias("subtype"), F.date_from_unix_date(day).alias("announced_at"), amount.alias("amount_cny"), amount.isNotNull().alias("disclosed"), F.array("o_orderstatus").alias("investors"),
        F.array(F.concat(F.lit("http://x.cn/"), (F.col("o_orderkey") % 4).cast("string")), F.concat(F.lit("http://y.cn/"), (F.floor("o_totalprice") % 6).cast("string"))).alias("urls"),
    )
    rows = reports.select("pos", day_of("announced_at").alias("day"), F.col("amount_cny").alias("amount"))
    merged = resolve.fold_financings(resolve.prepared_financings(reports)).join(rows, "pos")
    return merged.groupBy("financing").agg(F.count("*").alias("reports"), F.min("pos").alias("first_report"), (F.max("day") - F.min("day")).alias("days"), F.max("amount").alias("most"))


@query(f"""WITH o AS (SELECT CAST(user_id AS VARCHAR) AS url, max(ts) AS first_seen FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1), n AS (SELECT CAST(user_id AS VARCHAR) AS url, arg_max(event_type, event_id) AS reason, count(*) AS more FROM events WHERE event_type IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
 g AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS url FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-29 00:00:00')
 SELECT coalesce(o.url, n.url) AS url, coalesce(n.reason, 'error') AS reason, CASE WHEN o.url IS NULL THEN 0 ELSE 1 END + coalesce(n.more, 0) AS attempts, coalesce(o.first_seen, {NOW_SQL}) AS first_seen FROM o FULL JOIN n ON o.url = n.url WHERE coalesce(o.url, n.url) NOT IN (SELECT url FROM g)""")
def pending_upsert(spark, sf):
    """Errors of the first half of the month are the old leads, views and clicks since then the new ones, late purchases resolve."""
    e = table(spark, sf, "events").withColumn("url", F.col("user_id").cast("string"))
    middle, late = (F.expr(f"TIMESTAMP_NTZ '2024-01-{d} 00:00:00'") for d in (15, 29))
    old = e.where((F.col("event_type") == "error") & (F.col("ts") < middle)).groupBy("url").agg(F.lit("error").alias("reason"), F.lit(1).cast("long").alias("attempts"), F.max("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    new = e.where(F.col("event_type").isin("view", "click") & (F.col("ts") >= middle)).select("url", F.col("event_type").alias("reason"), F.col("event_id").alias("pos"))
    done = e.where((F.col("event_type") == "purchase") & (F.col("ts") >= late)).select("url")
    return state.resolve_pending(state.upsert_pending(old, new, now()), done).select("url", "reason", "attempts", "first_seen")


@query("SELECT user_id || '/' || event_type AS fingerprint, min(ts) AS published_at, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS event_id, arg_max(value, struct_pack(a := ts, b := event_id)) AS last_value FROM events GROUP BY 1")
def bucketed_state(spark, sf):
    """Three parts of the month, one after another, merged into a state in buckets; read back from its last version."""
    import uuid

    from ..sources import buckets, shared

    root = f"{shared.shared_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}"
    e = table(spark, sf, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("fingerprint"), F.col("ts").alias("published_at"), "event_id", F.col("value").alias("last_value"), F.col("ts").alias("last_at"), F.col("event_id").alias("last_id"))

    def merge(old, new):
        first, last = F.struct("published_at", "event_id"), F.struct("last_at", "last_id", "last_value")
        rows = old.unionByName(new).groupBy("fingerprint").agg(F.min(first).alias("f"), F.max(last).alias("l"))
        return rows.select("fingerprint", "f.published_at", "f.event_id", "l.last_value", "l.last_at", "l.last_id")

    middle, late = (F.expr(f"TIMESTAMP_NTZ '2024-01-{d} 00:00:00'") for d in (12, 22))
    at = F.col("published_at")
    for part in (e.where(at >= late), e.where(at < middle), e.where((at >= middle) & (at < late))):
        version = buckets.merge_into(spark, root, "events", part, ["fingerprint"], merge, 16)
    return buckets.load(spark, root, version, "events", e.schema).select("fingerprint", "published_at", "event_id", "last_value")


@query("SELECT user_id, count(*) AS n, max(ts) AS last_at, sum(event_id) AS ids, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def state_lines(spark, sf):
    """Events written as JSON lines and read back by the state's data source, with a schema that it enforces."""
    import uuid

    from ..sources import reader, shared
    from ..sources import state as files

    path = f"{shared.shared_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    files.write_lines(table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts"), path, "event_id")
    reader.register(spark)
    rows = spark.read.format(reader.NAME).schema("event_id long, user_id long, event_type string, ts timestamp_ntz").load(path)
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last_at"), F.sum("event_id").alias("ids"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query("SELECT event_id FROM events WHERE event_type = 'purchase' OR ts BETWEEN TIMESTAMP '2024-01-29 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00'")
def changed_in_window(spark, sf):
    e = table(spark, sf, "events")
    return state.changed(e, e.where("event_type = 'purchase'"), F.expr("TIMESTAMP_NTZ '2024-01-29 00:00:00'"), F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00'"), "event_id", "ts").select("event_id")


@query("""SELECT event_type AS category, count(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1
 UNION ALL SELECT 'financing', count(*) FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-05-01 00:00:00' - INTERVAL 3 MONTH AND TIMESTAMP '1998-05-01 00:00:00'""")
def trend_counts(spark, sf):
    e = table(spark, sf, "events").where("ts between TIMESTAMP_NTZ '2024-01-10 00:00:00' and TIMESTAMP_NTZ '2024-01-31 00:00:00'").groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("n"))
    start = F.expr("TIMESTAMP_NTZ '1998-05-01 00:00:00' - INTERVAL 3 MONTHS")
    o = table(spark, sf, "orders").where(F.col("o_orderdate").between(start, F.expr("TIMESTAMP_NTZ '1998-05-01 00:00:00'"))).agg(F.lit("financing").alias("category"), F.count("*").alias("n"))
    return e.unionByName(o)


@query(f"SELECT 'category' AS kind, event_type AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'status', CASE {_STAGE_SQL} WHEN 'intention' THEN 'upcoming' WHEN 'tender' THEN 'open' WHEN 'candidate' THEN 'evaluating' WHEN 'award' THEN 'awarded' WHEN 'failed' THEN 'failed' ELSE 'open' END, count(*) FROM events GROUP BY 2")
def trend_by_status(spark, sf):
    e = staged(spark, sf).withColumn("status", state.status_of(F.col("stage")))
    sets = e.groupBy("event_type", "status").agg(F.count("*").alias("n"))  # few rows; both counts come from it
    one = lambda kind, c: sets.groupBy(F.lit(kind).alias("kind"), F.col(c).alias("value")).agg(F.sum("n").alias("n"))
    return one("category", "event_type").unionByName(one("status", "status"))


@query(f"""SELECT count(*) AS raw, count(*) FILTER (n_chars > 100) AS valid, count(*) FILTER (n_chars > 100 AND r) AS relevant, count(*) FILTER (n_chars > 100 AND NOT r) AS rejected FROM (SELECT n_chars, ({_lexicon_sql(SUBJECTS)}) > 0 AS r FROM (SELECT n_chars, {_SAID_SQL} AS t FROM documents))""")
def funnel_counts(spark, sf):
    d = table(spark, sf, "documents").select("n_chars", text.squeezed(F.col("text")).alias("t")).select("n_chars", (lx.hits(F.col("t"), SUBJECTS) > 0).alias("r"))
    long_ = F.col("n_chars") > 100
    return d.agg(F.count("*").alias("raw"), F.count_if(long_).alias("valid"), F.count_if(long_ & F.col("r")).alias("relevant"), F.count_if(long_ & ~F.col("r")).alias("rejected"))


@query("""SELECT lang, source, count(*) AS n, count(DISTINCT n_chars) AS n_urls, arg_max(d.doc_id, struct_pack(a := coalesce(quality, -1), b := d.doc_id)) AS representative, count(DISTINCT n_chars) >= 2 OR bool_or(coalesce(quality, 0) = 1) AS high_confidence FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2""")
def signal_groups(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return report.groups(rows, ["lang", "source"], "n_chars", F.struct(F.coalesce("quality", F.lit(-1)), F.col("doc_id")), "doc_id", F.coalesce(F.col("quality"), F.lit(0)) == 1)


@query("""SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F' AND NOT EXISTS (SELECT 1 FROM orders v WHERE v.o_orderstatus = 'F' AND v.o_custkey = o.o_custkey AND v.o_orderpriority = o.o_orderpriority AND abs(date_diff('day', CAST(v.o_orderdate AS DATE), CAST(o.o_orderdate AS DATE))) <= 45)""")
def overlap_anti_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    return resolve.overlap_anti(o.where("o_orderstatus <> 'F'"), o.where("o_orderstatus = 'F'"), "o_custkey", "o_orderpriority", "o_orderdate").select("o_orderkey")


@query("SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00')")
def backfill_difference(spark, sf):
    e = table(spark, sf, "events")
    return e.where("ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'").select("user_id").distinct().join(e.where("ts >= TIMESTAMP_NTZ '2024-01-30 00:00:00'").select("user_id"), "user_id", "left_anti")


_GROUP_SQL = "CASE WHEN o_orderstatus = 'O' AND o_totalprice > 100000 THEN 'opportunity' WHEN o_orderstatus = 'P' THEN 'confirmation' ELSE 'result' END"


@query(f"SELECT grp, o_orderkey, place FROM (SELECT {_GROUP_SQL} AS grp, o_orderkey, row_number() OVER (PARTITION BY {_GROUP_SQL} ORDER BY CASE WHEN {_GROUP_SQL} = 'opportunity' THEN date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) ELSE -date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) END, o_orderkey) AS place FROM orders) WHERE place <= 3")
def procurement_groups(spark, sf):
    grp = F.when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000), "opportunity").when(F.col("o_orderstatus") == "P", "confirmation").otherwise("result")
    return report.top_per_group(table(spark, sf, "orders").withColumn("grp", grp), "grp", "o_orderdate", "o_orderkey", ("opportunity",), 3).select("grp", "o_orderkey", "place")


@query("SELECT conv_id, turn, count(*) FILTER (fresh) AS n_new FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, w ORDER BY turn) = 1 AS fresh FROM (SELECT DISTINCT conv_id, turn, w FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w FROM conversations))) GROUP BY 1, 2")
def search_trace_no_new(spark, sf):
    hits = table(spark, sf, "conversations").select("conv_id", "turn", F.explode(F.split("text", " ")).alias("w"))
    return followup.no_new(hits, "conv_id", "turn", "w")


@query("SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderpriority, o_orderdate DESC, o_totalprice DESC, o_custkey, o_orderkey) AS place FROM orders) WHERE place <= 100")
def followup_rank(spark, sf):
    order = [F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).asc(), F.asc("o_orderpriority"), F.desc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_custkey"), F.asc("o_orderkey")]
    top = table(spark, sf, "orders").orderBy(*order).limit(100)  # a top-k report
    return top.select("o_orderkey", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


def numbered(df: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """(key, place) of the first rows in an order: a top-k report."""
    top = df.orderBy(*order).limit(most)
    return top.select(key, F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query(f"""SELECT page_id, place FROM (SELECT p.page_id, row_number() OVER (ORDER BY CASE WHEN starts_with(source, 'src1') THEN 0 WHEN host = 'example.org' OR ends_with(host, '.example.org') THEN 1 ELSE 2 END, pub DESC NULLS LAST, score DESC, url) AS place
 FROM (SELECT page_id, url || '#' || page_id AS url, {_HOST_SQL} AS host, CASE WHEN page_id % 9 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id % 30 AS INTEGER)) END AS pub, page_id % 4 AS score FROM pages) p JOIN documents d ON d.doc_id = p.page_id) WHERE place <= 80""")
def candidate_rank(spark, sf):
    """Pages as candidates: those of one source are official, those below one domain preferred."""
    pages = table(spark, sf, "pages").select("page_id", F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url"), (F.col("page_id") % 4).alias("score"), F.when(F.col("page_id") % 9 != 0, F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval((F.col("page_id") % 30).cast("int"))).alias("published_at"))
    sources = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.when(F.col("source").startswith("src1"), "official:x").otherwise("search").alias("discovery_source"))
    return numbered(pages.join(sources, "page_id"), "page_id", select.rank_order(["example.org"]), 80)


_REASON_OF = {"1-URGENT": "financing_requires_independent_sources", "2-HIGH": "missing_required_fields:published_at", "3-MEDIUM": "classification_evidence_invalid", "4-NOT SPECIFIED": "financing_corroboration_conflict", "5-LOW": "unknown"}


@query("""SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN o_orderpriority = '2-HIGH' THEN 0 WHEN o_orderkey % 3 <= 1 THEN 1 ELSE 2 END,
 (o_custkey % 5 = 0)::INT + (o_orderkey % 7 = 0)::INT + (o_custkey % 2 = 0 AND o_orderstatus <> 'F')::INT, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END,
 CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderkey % 4, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate ELSE TIMESTAMP '1970-01-01 00:00:00' END DESC, 'u' || o_orderkey) AS place FROM orders) WHERE place <= 200""")
def followup_priority(spark, sf):
    """Orders as leads, in the order in which they are followed up."""
    k, c, none = F.col("o_orderkey"), F.col("o_custkey"), F.lit(None).cast("string")
    lead = {
        "official": F.when(c % 3 == 0, 2).otherwise(0), "gaps": F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (k % 3).cast("int")), "reason": lx.mapped(F.col("o_orderpriority"), _REASON_OF, F.lit("unknown")), "organization": F.when(c % 5 != 0, "x").otherwise(F.lit("")),
        "published_at": F.when(k % 7 != 0, F.col("o_orderdate").cast("timestamp_ntz")), "category": F.lit("c"), "event_type": F.lit("e"), "round": F.when(c % 2 == 1, "A"), "amount": F.when(F.col("o_orderstatus") == "F", "1").otherwise(none),
        "grade": lx.mapped(F.col("o_orderstatus"), {"O": "B", "F": "A"}, F.lit("C")), "attempts": k % 4, "url": F.concat(F.lit("u"), k.cast("string")),
    }
    return numbered(table(spark, sf, "orders"), "o_orderkey", followup.priority(lead), 200)


@query("""SELECT event_id, place FROM (SELECT event_id, row_number() OVER (ORDER BY CASE WHEN pub IS NULL THEN 2 WHEN d < 0 THEN 3 WHEN d <= 7 THEN 0 WHEN d <= 30 THEN 1 ELSE 3 END, pub DESC NULLS LAST, 'i' || event_id) AS place
 FROM (SELECT event_id, pub, CAST(floor(date_diff('microsecond', pub, TIMESTAMP '2024-01-31 00:00:00') / 86400000000.0) AS BIGINT) AS d FROM (SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN ts - INTERVAL 9 DAY END AS pub FROM events))) WHERE place <= 300""")
def pending_rank(spark, sf):
    """Events as the pending pool, in the order in which it is shown."""
    at = F.when(F.col("event_id") % 6 != 0, F.col("ts") - F.make_dt_interval(F.lit(9)))
    return numbered(table(spark, sf, "events"), "event_id", report.pending_order(at, now(), F.concat(F.lit("i"), F.col("event_id").cast("string"))), 300)


@query(f"""WITH a AS (SELECT o_orderkey AS k, o_custkey % 11 <> 0 AS scope, concat_ws(',', CASE WHEN o_orderkey % 17 = 0 THEN 'title' END, CASE WHEN o_custkey % 29 = 0 THEN 'organization' END) AS gaps, o_orderstatus = 'F' AS fin, o_orderstatus = 'F' AND o_orderkey % 19 <> 0 AS fin_event,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'A' WHEN '3-MEDIUM' THEN 'B' WHEN '5-LOW' THEN 'B' ELSE 'C' END AS grade, o_custkey FROM orders),
 r AS (SELECT k, CASE WHEN NOT scope THEN 'out_of_scope' WHEN gaps <> '' THEN 'missing_required_fields:' || gaps WHEN k % 13 = 0 THEN 'source_url_mismatch' WHEN k % 5 = 0 THEN 'evidence_not_grounded' WHEN fin <> fin_event THEN 'category_event_type_mismatch' WHEN o_custkey % 9 = 0 THEN 'source_unavailable'
  WHEN NOT fin AND grade <> 'A' THEN 'tender_requires_grade_a' WHEN NOT fin AND k % 3 = 0 THEN 'class' WHEN NOT fin AND k % 4 = 0 THEN 'deadline' WHEN NOT fin AND k % 7 = 0 THEN 'tender_missing_required_evidence' WHEN NOT fin AND k % 11 = 0 THEN 'evidence_not_grounded' WHEN NOT fin THEN 'verified_tender'
  WHEN grade IN ('A', 'B') AND k % 3 = 0 THEN 'class' WHEN grade IN ('A', 'B') AND k % 7 = 0 THEN 'money' WHEN grade = 'A' THEN 'verified_financing_official_source' WHEN grade = 'B' AND k % 2 = 0 THEN 'verified_financing_two_independent_sources' WHEN grade = 'B' AND k % 11 = 0 THEN 'conflict'
  ELSE 'financing_requires_official_or_two_independent_b_sources' END AS reason FROM a)
 SELECT k AS o_orderkey, CASE WHEN reason = 'out_of_scope' THEN 'rejected' WHEN starts_with(reason, 'verified') THEN 'verified' ELSE 'pending' END AS status, reason FROM r""")
def verification_decisions(spark, sf):
    """Orders as analyses of which each rule of the cascade stops some."""
    k, c, fin = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus") == "F"
    when = lambda cond, v: F.when(cond, F.lit(v))
    a = {
        "in_china": c % 11 != 0, "in_scope": F.lit(True), "title": when(k % 17 != 0, "t"), "organization": F.when(c % 29 == 0, F.lit(" ")).otherwise(F.lit("o")), "published_at": F.col("o_orderdate"), "category": F.when(fin, lx.FINANCING).otherwise("eo_turret"),
        "event_type": F.when(fin & (k % 19 != 0), "financing").otherwise("tender"), "url_matches": k % 13 != 0, "grounded": k % 5 != 0, "http_status": F.when(c % 9 == 0, 404).otherwise(200),
        "grade": lx.mapped(F.col("o_orderpriority"), {"1-URGENT": "A", "2-HIGH": "A", "3-MEDIUM": "B", "5-LOW": "B"}, F.lit("C")), "class_failure": when(k % 3 == 0, "class"), "deadline_failure": when(k % 4 == 0, "deadline"), "tender_evidence": k % 7 != 0, "tender_claims": k % 11 != 0,
        "financing_failure": when(k % 7 == 0, "money"), "corroborated": k % 2 == 0, "corroboration_reason": when(k % 11 == 0, "conflict"),
    }
    status, reason = verify.decision(a)
    return table(spark, sf, "orders").select("o_orderkey", status.alias("status"), reason.alias("reason"))


@query()
def html_date_evidence(spark, sf):
    from ..sources import html

    return html.page_rows(table(spark, sf, "pages"), "page_id", "html")


_LIST_SELECTORS = ("nav ul > li a[href]", 'body > nav a[href^="/t"], nav a[href^="/d"]', "div.ad a", "a[")


@query(r"""WITH p AS (SELECT page_id, page_id % 4 AS k, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS base, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS names FROM pages),
 l AS (SELECT page_id, k, base, unnest(hrefs) AS href, unnest(names) AS name, unnest(range(len(hrefs))) AS n FROM p WHERE k < 2), c AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS pos FROM l WHERE k = 0 OR starts_with(href, '/t') OR starts_with(href, '/d'))
 SELECT page_id, CAST(pos AS INTEGER) AS pos, base || href AS url, name AS title, NULL AS failure FROM c
 UNION ALL SELECT page_id, NULL, NULL, NULL, CASE WHEN k = 3 THEN 'bad_selector' ELSE 'no_links' END FROM p WHERE k >= 2 OR page_id NOT IN (SELECT page_id FROM c)""")
def list_links(spark, sf):
    """Links of the pages' navigation by four selectors, of which one finds nothing and one is none."""
    from ..sources import listing

    selector = F.element_at(F.array(*[F.lit(s) for s in _LIST_SELECTORS]), (F.col("page_id") % 4).cast("int") + 1)
    pages = table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("domain"), F.col("url").alias("list_url"), selector.alias("link_selector"), F.lit(200).alias("status"), "html")
    return listing.collected(pages, "page_id").select("page_id", "pos", "url", "title", "failure")


@query(f"""WITH x AS (SELECT CASE {_STAGE_SQL} WHEN 'award' THEN 0 WHEN 'tender' THEN 1 ELSE 2 END AS section, event_id AS pos, {_STAGE_SQL} || ' ' || user_id AS line FROM events)
 SELECT section, pos, line FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY section, pos) AS n FROM x) WHERE n = 1""")
def report_sections(spark, sf):
    """Each line once, in the first section that has it."""
    lines = staged(spark, sf).select(F.when(F.col("stage") == "award", 0).when(F.col("stage") == "tender", 1).otherwise(2).alias("section"), F.col("event_id").alias("pos"), F.concat_ws(" ", "stage", F.col("user_id").cast("string")).alias("line"))
    return report.first_sections(lines, "section", "pos", "line")


# --------------------------------------------------------------------- claims, extraction and follow-up
_EV = "array<struct<field:string,quote:string,source_url:string>>"


def _quotes(**quotes: Column) -> Column:
    """Evidence with one quote for each field whose quote is not null."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), q.cast("string").alias("quote"), F.lit("u").alias("source_url")) for f, q in quotes.items()])
    return F.filter(each, lambda e: e["quote"].isNotNull())


@query("""SELECT o_orderkey, CASE o_orderkey % 9 WHEN 1 THEN 'financing_missing_required_evidence' WHEN 2 THEN 'evidence_not_grounded' WHEN 3 THEN 'evidence_not_grounded' WHEN 4 THEN 'evidence_not_grounded' WHEN 6 THEN 'financing_missing_required_evidence' WHEN 7 THEN 'evidence_not_grounded' END AS failure,
 CASE o_orderkey % 9 WHEN 1 THEN 'amount' WHEN 2 THEN 'published_at' WHEN 3 THEN 'financing_round' WHEN 4 THEN 'amount' WHEN 6 THEN 'amount' ELSE '' END AS gaps,
 CASE o_orderkey % 9 WHEN 1 THEN 'financing_source_amount_evidence_invalid' WHEN 2 THEN 'financing_source_publication_date_evidence_invalid' WHEN 3 THEN 'financing_source_round_evidence_invalid' WHEN 4 THEN 'financing_source_amount_evidence_invalid' WHEN 7 THEN 'financing_source_action_evidence_invalid' END AS source_failure,
 CASE WHEN o_orderkey % 9 IN (5, 6) THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) * 10000 AS VARCHAR) END AS amount_key FROM orders""")
def financing_claims(spark, sf):
    """Orders as financings of which seven in nine lack or distort one proof each."""
    k, price = F.col("o_orderkey") % 9, F.floor("o_totalprice").cast("string")
    company = F.concat(F.lit("客户 "), F.col("o_custkey").cast("string"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.lit("t").alias("title"), company.alias("organization"), F.col("o_orderdate").alias("published_at"), F.lit("B").alias("financing_round"), F.lit(None).cast("string").alias("financing_subtype"),
        F.when(~k.isin(5, 6), F.concat(price, F.lit("万元"))).alias("amount"), F.when(k == 5, False).when(k != 6, True).alias("amount_disclosed"), F.array(F.lit("投资 甲")).alias("investors"), F.lit(None).cast("string").alias("business_area"),
        _quotes(
            organization=F.concat(company, F.lit("，宣布")), published_at=F.when(k == 2, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy年M月d日")),
            amount=F.when(k == 4, F.lit("融资 3 元")).when(k == 5, F.lit("金额未披露")).when(k != 1, F.concat(F.lit("融资"), price, F.lit(".0 万元"))), financing_round=F.when(k == 3, F.lit("PreB轮")).otherwise(F.lit("完成 B 轮")), investors=F.lit("投资甲领投"),
            event_type=F.when(k == 7, F.lit("发布产品")).otherwise(F.lit("完成融资")),
        ).alias("evidence"),
    )
    return claims.prepared(rows).select("o_orderkey", claims.financing_failure().alias("failure"), F.array_join(claims.financing_gaps(), ",").alias("gaps"), claims.source_failure().alias("source_failure"), claims.amount_key(F.col("forms.amount")).alias("amount_key"))


@query(f"""SELECT page_id, CASE WHEN host LIKE '%.example.org' OR host = 'example.org' THEN 'B' WHEN (host LIKE '%.example.com' OR host = 'example.com') AND page_id % 2 = 0 THEN 'A' WHEN (host LIKE '%.example.net' OR host = 'example.net') AND page_id % 3 = 0 THEN 'A' ELSE 'C' END AS grade FROM (SELECT page_id, {_HOST_SQL} AS host FROM pages)""")
def financing_grades(spark, sf):
    registry = spark.createDataFrame([("example.com", "company", ["acme"]), ("example.org", "media", []), ("example.net", "investor", ["fund"])], "domain string, kind string, aliases array<string>")
    rows = table(spark, sf, "pages").select(
        "page_id", urls.host(F.col("url")).alias("host"), F.when(F.col("page_id") % 2 == 0, "Acme").otherwise("Other").alias("organization"), F.array(F.lit("Fund")).alias("investors"), _quotes(investors=F.when(F.col("page_id") % 3 == 0, F.lit("led by FUND."))).alias("evidence"),
        *[F.lit(None).cast("string").alias(c) for c in ("title", "financing_round", "amount", "business_area")],
    )
    return claims.grade_financing(claims.prepared(rows), registry).select("page_id", "grade")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN 'deadline_evidence_missing' WHEN 2 THEN 'deadline_evidence_invalid' WHEN 3 THEN 'deadline_evidence_invalid' END AS failure FROM orders""")
def deadline_claims(spark, sf):
    """Bid deadlines at minute precision whose quote is right, absent, of another day, or without the time."""
    k, at = F.col("o_orderkey") % 5, F.col("o_orderdate") + F.make_dt_interval(F.lit(30), (F.col("o_orderkey") % 24).cast("int"), F.lit(7))
    quote = F.when(k == 2, F.lit("投标截止 1970-01-01 00:07")).when(k == 3, F.concat(F.lit("投标截止 "), F.date_format(at, "yyyy.MM.dd"))).when(k != 1, F.concat(F.lit("投标截止 "), F.date_format(at, "yyyy-MM-dd HH:mm")))
    rows = table(spark, sf, "orders").select("o_orderkey", at.alias("at"), _quotes(bid_submission_deadline=quote).alias("evidence"), F.array().cast("array<string>").alias("investors"), *[F.lit(None).cast("string").alias(c) for c in claims.CLAIMS])
    failure = claims.deadline_failure(F.create_map(F.lit("bid_submission"), F.col("at")), F.create_map(F.lit("bid_submission"), F.lit("minute")))
    return claims.prepared(rows).select("o_orderkey", failure.alias("failure"))


@query("""SELECT o_orderkey, '客户' || o_custkey AS organization, CASE WHEN o_orderkey % 3 <> 0 THEN '供应商' || o_orderkey END AS supplier, CAST(floor(o_totalprice) AS BIGINT) || '万元' AS amount, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS published, 'award' AS event_type FROM orders""")
def notice_fields(spark, sf):
    """Fields of award notices; masked suppliers do not count."""
    said = F.concat(F.lit("采购人："), F.concat(F.lit("客户"), F.col("o_custkey").cast("string")), F.lit("。\n中标供应商："), F.when(F.col("o_orderkey") % 3 == 0, "***").otherwise(F.concat(F.lit("供应商"), F.col("o_orderkey").cast("string"))), F.lit("；\n中标金额："), F.floor("o_totalprice").cast("string"), F.lit("万元\n发布于 "), F.date_format(F.add_months("o_orderdate", 240), "yyyy年M月d日"))
    rows = table(spark, sf, "orders").select("o_orderkey", said.alias("t"))
    return rows.select("o_orderkey", extract.organization(F.col("t"))["value"].alias("organization"), extract.supplier(F.col("t"))["value"].alias("supplier"), extract.award_amount(F.col("t"))["value"].alias("amount"), extract.date(F.col("t"))["value"].alias("published"), extract.event_type(F.col("t"), F.lit(None).cast("string")).alias("event_type"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 2, 4) THEN TRUE ELSE FALSE END AS domestic, CASE WHEN p_partkey % 5 = 0 THEN '北京零件' || p_partkey || '科技有限公司' END AS subject FROM part""")
def domestic_subjects(spark, sf):
    """Titles that name a domestic company, a foreign buyer, or nobody; then the lead or the source decides."""
    k, n = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    title = F.when(k == 0, F.concat(F.lit("北京零件"), n, F.lit("科技有限公司采购公告"))).when(k == 1, F.concat(F.lit("美国采购零件"), n)).otherwise(F.concat(F.lit("零件"), n, F.lit("公告")))
    lead = F.when(k == 2, F.lit("国内项目招标")).when(k == 3, F.lit("日本的项目")).otherwise(F.lit("说明"))
    rows = table(spark, sf, "part").select("p_partkey", title.alias("t"), lead.alias("l"), (k == 4).alias("a"))
    return rows.select("p_partkey", extract.domestic_subject(F.col("t"), F.col("l"), F.col("a")).alias("domestic"), extract.subject_quote(F.col("t")).alias("subject"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '客户' || o_custkey || '完成' || CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE '股权融资' END || '，披露金额' || CAST(floor(o_totalprice) AS BIGINT) || '元' ELSE '客户' || o_custkey || CASE o_orderstatus WHEN 'F' THEN '公布中标结果' WHEN 'O' THEN '启动招标采购' ELSE '发布采购信息' END || '，项目金额' || CAST(floor(o_totalprice) AS BIGINT) || '元' END AS summary FROM orders""")
def composed_summaries(spark, sf):
    n, none = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    financed = F.col("o_orderkey") % 2 == 0
    sentence = extract.composed_summary(
        F.when(financed, lx.FINANCING).otherwise("eo_turret"), F.lit("t"), F.concat(F.lit("客户"), F.col("o_custkey").cast("string")), F.when(F.col("o_orderstatus") == "F", "award").when(F.col("o_orderstatus") == "O", "tender").otherwise("other"),
        F.concat(F.floor("o_totalprice").cast("string"), F.lit("元")), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")), none, n, n, n,
    )
    return table(spark, sf, "orders").select("o_orderkey", sentence.alias("summary"))


@query("""WITH m AS (SELECT o_orderkey AS k, o_orderstatus AS category, o_orderkey % 7 <> 0 AS in_scope, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS event_type, CASE WHEN o_orderkey % 3 = 0 THEN 'm' || o_custkey END AS organization FROM orders WHERE o_orderkey % 11 <> 0),
 r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'Z' ELSE o_orderstatus END AS category, TRUE AS in_scope, o_orderpriority AS event_type, 'r' || o_custkey AS organization FROM orders)
 SELECT r.k AS o_orderkey, CASE WHEN m.k IS NULL THEN r.category ELSE m.category END AS category, CASE WHEN m.k IS NULL OR (m.in_scope AND m.category = r.category) THEN coalesce(m.event_type, r.event_type) ELSE m.event_type END AS event_type,
 CASE WHEN m.k IS NULL OR (m.in_scope AND m.category = r.category) THEN coalesce(m.organization, r.organization) ELSE m.organization END AS organization FROM r LEFT JOIN m ON m.k = r.k""")
def enriched_analyses(spark, sf):
    """A model's rows with gaps, completed from rule rows unless they are out of scope or contradict each other."""
    k, none = F.col("o_orderkey"), F.lit(None)
    base = [none.cast("timestamp").alias("published_at"), none.cast("string").alias("amount"), none.cast("boolean").alias("amount_disclosed"), F.array().cast(_EV).alias("evidence")]
    orders = table(spark, sf, "orders")
    model = orders.where(k % 11 != 0).select(k.alias("source_url"), F.lit(True).alias("in_china"), (k % 7 != 0).alias("in_scope"), F.col("o_orderstatus").alias("category"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("event_type"), F.when(k % 3 == 0, F.concat(F.lit("m"), F.col("o_custkey").cast("string"))).alias("organization"), *base)
    rules = orders.select(k.alias("source_url"), F.lit(True).alias("in_china"), F.lit(True).alias("in_scope"), F.when(k % 5 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("category"), F.col("o_orderpriority").alias("event_type"), F.concat(F.lit("r"), F.col("o_custkey").cast("string")).alias("organization"), *base)
    return enrich.enriched(model, rules).select(F.col("source_url").alias("o_orderkey"), "category", "event_type", "organization")


@query("""WITH q AS (SELECT c_custkey, unnest(CASE WHEN c_custkey % 2 = 0 THEN ['客户' || c_custkey || ' A轮 融资 投资方 领投 跟投 官网 投资机构 官方披露 site:c.cn', '客户' || c_custkey || ' A轮 融资 投资方 领投 跟投 领投方 投资方 site:n.cn', '客户' || c_custkey || ' A轮 融资 投资方 领投 跟投 领投方 投资方', '客户' || c_custkey || ' A轮 融资 投资方 领投 跟投 新闻 报道', '客户' || c_custkey || ' A轮 融资 投资方 领投 跟投 权威媒体 融资公告']
 ELSE ['客户' || c_custkey || ' ' || c_mktsegment || ' 官方公告', '客户' || c_custkey || ' ' || c_mktsegment || ' 项目编号', '客户' || c_custkey || ' ' || c_mktsegment || ' 中标 变更 延期 终止'] END) AS text FROM customer) SELECT c_custkey, text || ' 最近90天 中国境内' AS query FROM q""")
def followup_queries(spark, sf):
    """Search texts for each customer: even ones are financings with an official site, odd ones procurements."""
    even, none = F.col("c_custkey") % 2 == 0, F.array().cast("array<string>")
    asked = followup.queries_for(F.when(even, lx.FINANCING).otherwise("eo_turret"), F.concat(F.lit("客户"), F.col("c_custkey").cast("string")), F.col("c_mktsegment"), F.lit("A轮"), none, F.array(F.lit("investors")), F.array(F.lit("c.cn")), F.array(F.lit("m.cn")), ["m.cn", "n.cn"])
    return table(spark, sf, "customer").select("c_custkey", F.explode(asked).alias("query"))


@query(f"""WITH v AS (SELECT page_id, {_NURL_SQL} AS u, sha256('{{"content_hash":"h' || page_id || '","source_url":"' || ({_NURL_SQL}) || '"}}') AS version, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id AS INTEGER)) AS pub FROM pages),
 f AS (SELECT page_id, version, sha256('{{"content_version_id":"' || version || '","event_type":"tender","published_at":"' || strftime(pub, '%Y-%m-%dT%H:%M:%S.%fZ') || '","source_url":"' || u || '","title":"page ' || page_id || '"}}') AS fingerprint FROM v), d AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('gleaner:event:' || fingerprint)) AS h FROM f)
 SELECT page_id, version, fingerprint, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS event_id FROM d""")
def event_rows(spark, sf):
    """Pages as formal events: version of URL and content, fingerprint and id."""
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(F.col("page_id").cast("int"))
    rows = table(spark, sf, "pages").select("page_id", F.lit("tender").alias("event_type"), at.alias("published_at"), F.col("url").alias("source_url"), F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"), F.concat(F.lit("H"), F.col("page_id").cast("string")).alias("content_hash"), at.alias("discovered_at"))
    return state.event_rows(rows).select("page_id", F.col("content_version_id").alias("version"), "fingerprint", "event_id")


_BARE_SQL = r"""regexp_replace(lower(regexp_replace({0}, '[\s·•（）()“”"'']', '', 'g')), '(?:有限责任公司|股份有限公司|有限公司|公司)$', '')"""


@query(f"""WITH r AS (SELECT 'd' || item_id % 13 AS domain, array_to_string(string_split(text, ' ')[1:2], ' ') AS alias FROM benchmark)
 SELECT doc_id, domain, arg_min(alias, struct_pack(n := length(alias), a := alias)) AS alias FROM documents JOIN r ON {_BARE_SQL.format("alias")} <> '' AND contains({_BARE_SQL.format("text")}, {_BARE_SQL.format("alias")}) GROUP BY 1, 2""")
def registry_names(spark, sf):
    """The first two words of benchmark items as names of thirteen domains, in all documents."""
    items = table(spark, sf, "benchmark").withColumn("place", (F.col("item_id") % 13).cast("int"))
    registry = items.select(F.lit("company").alias("kind"), "place", F.concat(F.lit("d"), F.col("place").cast("string")).alias("domain"), F.array_join(F.slice(F.split("text", " "), 1, 2), " ").alias("alias"))
    return aliases.named_in(table(spark, sf, "documents"), registry, "doc_id", "text").select("doc_id", "domain", "alias")


@query("""WITH RECURSIVE f AS (SELECT o_orderkey AS id, o_custkey AS company, o_orderpriority AS pr, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) % 120 AS INTEGER) AS day, ['s/' || o_orderkey % 5, 't/' || o_custkey % 2 || CAST(o_orderkey % 3 AS VARCHAR)] AS urls, o_orderkey % 6 = 0 AS changed FROM orders WHERE o_orderstatus <> 'P'),
 v AS (SELECT *, CASE pr WHEN '1-URGENT' THEN ['a'] WHEN '2-HIGH' THEN ['a', 'b'] WHEN '3-MEDIUM' THEN ['b'] WHEN '5-LOW' THEN ['prea'] ELSE [] END AS rounds, row_number() OVER (PARTITION BY company ORDER BY changed DESC, day DESC, lpad(CAST(id AS VARCHAR), 9, '0')) AS k FROM f WHERE day >= 20),
 s AS (SELECT company, k, id, TRUE AS kept, [{'day': day, 'rounds': rounds, 'urls': urls}] AS ls FROM v WHERE k = 1
  UNION ALL SELECT company, k, id, NOT same, CASE WHEN same THEN ls ELSE list_append(ls, {'day': day, 'rounds': rounds, 'urls': urls}) END
  FROM (SELECT v.*, s.ls, len(list_filter(s.ls, lambda l: list_has_any(l.urls, v.urls) AND abs(l.day - v.day) <= 45 AND len(l.rounds) > 0 AND len(v.rounds) > 0 AND (list_has_all(l.rounds, v.rounds) OR list_has_all(v.rounds, l.rounds)))) > 0 AS same FROM s JOIN v ON v.company = s.company AND v.k = s.k + 1))
 SELECT s.id AS o_orderkey, CASE WHEN day >= 110 THEN 'daily' WHEN changed THEN 'historical' ELSE 'rolling' END AS label, '- **【' || CASE WHEN day >= 110 THEN '已核实·今日新增' WHEN changed THEN '已核实·历史补录' ELSE '已核实·滚动池' END || '】客户' || s.company || '完成' ||
  CASE pr WHEN '1-URGENT' THEN 'A轮' WHEN '2-HIGH' THEN 'A轮、B轮' WHEN '3-MEDIUM' THEN 'B轮' WHEN '5-LOW' THEN 'Pre-A轮' ELSE '战略融资' END || '**' AS headline, '  - 来源：[来源1](' || least(urls[1], urls[2]) || ')｜[来源2](' || greatest(urls[1], urls[2]) || ')' AS links FROM s JOIN v ON v.id = s.id WHERE kept""")
def financing_items(spark, sf):
    """Orders as verified financings of a rolling window, one item for each event that is shown, with its lines."""
    k, pr, day = F.col("o_orderkey"), F.col("o_orderpriority"), F.pmod(day_of("o_orderdate"), F.lit(120))
    at = lambda n: F.date_from_unix_date(F.lit(n)).cast("timestamp_ntz")
    rows = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.lpad(k.cast("string"), 9, "0").alias("financing_id"), F.lit("verified").alias("status"), F.concat(F.lit("客户"), F.col("o_custkey").cast("string")).alias("company"), lx.mapped(pr, _ROUND_OF, F.lit(None).cast("string")).alias("round_name"),
        F.when(pr == "4-NOT SPECIFIED", F.lit("strategic")).alias("subtype"), F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz").alias("announced_at"), F.create_map().cast("map<string,timestamp_ntz>").alias("source_dates"),
        F.concat(F.lit("s/"), (k % 5).cast("string")).alias("source_url"), F.array(F.concat(F.lit("t/"), (F.col("o_custkey") % 2).cast("string"), (k % 3).cast("string"))).alias("source_urls"), F.lit(None).cast("double").alias("amount_cny"), F.lit(False).alias("amount_disclosed"),
        F.array().cast("array<string>").alias("investors"), *[F.lit(None).cast("string").alias(c) for c in ("business_area", "brief_summary")], F.array().cast(_EV).alias("evidence"),
    )
    found = items.financing_lines(items.shown(rows, rows.where(F.col("financing_id").cast("long") % 6 == 0), at(20), at(119)), at(110), at(119))
    return found.select(F.col("financing_id").cast("long").alias("o_orderkey"), "label", F.element_at("lines", 1).alias("headline"), F.element_at("lines", -1).alias("links"))


@query("""WITH e AS (SELECT 'e' || event_id AS event_id, user_id, event_type, ts, event_id % 5 <> 0 AS good, event_id % 7 <> 0 AS formal FROM events),
 p AS (SELECT user_id, max(ts) AS latest_at, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS event_id, arg_max(good, struct_pack(a := ts, b := event_id)) AS good FROM e WHERE user_id % 2 = 0 AND event_type IN ('click', 'purchase', 'signup') GROUP BY 1),
 w AS (SELECT * FROM p WHERE good AND latest_at BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'),
 r AS (SELECT 'project' AS kind, 'p' || user_id AS id, latest_at, user_id % 6 = 0 AS changed, event_id FROM w
  UNION ALL SELECT 'event', event_id, ts, event_type = 'error', event_id FROM e WHERE good AND formal AND ts BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00' AND NOT (event_type IN ('click', 'purchase', 'signup') AND user_id IN (SELECT user_id FROM w)))
 SELECT kind, id, latest_at, CASE WHEN latest_at >= TIMESTAMP '2024-01-30 00:00:00' THEN 'daily' WHEN changed THEN 'historical' ELSE 'rolling' END AS label, event_id FROM r""")
def procurement_items(spark, sf):
    """Even users' clicks, signups and purchases as projects, all events as notices: projects and uncovered notices to show."""
    e = table(spark, sf, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), "user_id", "event_type", F.col("ts").alias("published_at"), F.when(F.col("event_id") % 5 != 0, "verified").otherwise("pending").alias("status"), (F.col("event_id") % 7 != 0).alias("formal"))
    p = e.where((F.col("user_id") % 2 == 0) & F.col("event_type").isin("click", "purchase", "signup")).groupBy("user_id").agg(F.collect_list("event_id").alias("event_ids"), F.max("published_at").alias("latest_event_at")).withColumn("project_id", F.concat(F.lit("p"), F.col("user_id").cast("string")))
    at = lambda d: F.expr(f"TIMESTAMP_NTZ '2024-01-{d} 00:00:00'")
    found = items.procurements(p, e.drop("user_id"), p.where("user_id % 6 = 0"), e.where("event_type = 'error'"), at(20), at(31), at(30), at(31))
    return found.select("kind", "id", "latest_at", "label", "event_id")


_SIGNAL_SQL = f"""WITH o AS (SELECT o_orderkey AS pos, '客户' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS name, o_orderstatus AS st, o_orderpriority AS pr, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) % 365 AS INTEGER) AS day, 'http://d/' || o_orderkey % 2900 AS url,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN 'eo_turret' ELSE '{lx.FINANCING}' END AS category, CASE o_orderpriority WHEN '1-URGENT' THEN 'A轮' WHEN '2-HIGH' THEN 'B轮' END AS round FROM orders),
 x AS (SELECT *, name || CASE WHEN pr = '3-MEDIUM' THEN ' Pre-A轮融资' ELSE ' 融资' || pos END AS title FROM o),
 v AS (SELECT name, CASE pr WHEN '1-URGENT' THEN ['a'] WHEN '2-HIGH' THEN ['b'] WHEN '3-MEDIUM' THEN ['prea'] ELSE [] END AS rounds, day FROM x WHERE st = 'F' AND pos % 2 = 0),
 l AS (SELECT *, CASE WHEN st = 'P' THEN 1 WHEN st = 'F' THEN 2 ELSE 0 END AS branch, CASE WHEN st = 'O' AND round IS NOT NULL THEN round ELSE title END AS said FROM x WHERE category IS NOT NULL AND (st = 'P' OR (st = 'F' AND pos % 2 = 1) OR (st = 'O' AND pos % 4 <> 0))),
 m AS (SELECT *, CASE said WHEN 'A轮' THEN ['a'] WHEN 'B轮' THEN ['b'] ELSE CASE WHEN contains(said, 'Pre-A') THEN ['prea'] ELSE [] END END AS mine FROM l),
 k AS (SELECT * FROM m WHERE NOT (category = '{lx.FINANCING}' AND EXISTS (SELECT 1 FROM v WHERE v.name = m.name AND (len(v.rounds) = 0 OR list_has_any(v.rounds, m.mine)) AND abs(v.day - m.day) <= 45))),
 d AS (SELECT *, CASE WHEN pos % 3 = 0 THEN 'e' || name ELSE concat_ws('|', category, name, coalesce(round, ''), title) END AS identity, pos % 7 AS n, pos % 2 = 0 AS graded FROM k WHERE branch = 0),
 g AS (SELECT identity, 0 AS branch, min(pos) AS first_pos, arg_max(title, struct_pack(a := n, b := graded, c := url, d := -pos)) AS title, list_sort(list(DISTINCT url)) AS urls, bool_or(graded AND n >= 5) AS strong FROM d GROUP BY 1), s1 AS (SELECT DISTINCT unnest(urls) AS url FROM g),
 p AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM k WHERE branch = 1 AND url NOT IN (SELECT url FROM s1)),
 c AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM k WHERE branch = 2 AND url NOT IN (SELECT url FROM s1) AND url NOT IN (SELECT url FROM x WHERE st = 'P'))"""


@query(f"""{_SIGNAL_SQL} SELECT branch, first_pos, title, CASE WHEN len(urls) >= 2 OR strong THEN 'high_confidence' ELSE 'candidate' END AS label, array_to_string(urls, ',') AS urls, identity FROM g
 UNION ALL SELECT 1, pos, title, 'candidate', url, 'pending:' || pos FROM p WHERE r = 1 UNION ALL SELECT 2, pos, title, 'candidate', url, 'candidate:' || url FROM c WHERE r = 1""")
def unverified_signals(spark, sf):
    """Open orders as diagnostics, orders in process as the pool, half of the filled ones as candidates, the others as verified."""
    k, pr = F.col("o_orderkey"), F.col("o_orderpriority")
    name = F.concat(F.lit("客户"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))
    us = (F.pmod(day_of("o_orderdate"), F.lit(365)).cast("long") * 86_400_000_000).alias("published_us")
    rows = table(spark, sf, "orders").select(
        k.alias("pos"), "o_orderstatus", name.alias("organization"), F.concat(F.lit("http://d/"), (k % 2900).cast("string")).alias("url"), F.when(pr == "5-LOW", "eo_turret").when(pr != "4-NOT SPECIFIED", lx.FINANCING).alias("category"),
        F.concat(name, F.when(pr == "3-MEDIUM", F.lit(" Pre-A轮融资")).otherwise(F.concat(F.lit(" 融资"), k.cast("string")))).alias("title"), F.when(pr == "1-URGENT", "A轮").when(pr == "2-HIGH", "B轮").alias("financing_round"), us,
        F.when(k % 3 == 0, F.concat(F.lit("e"), name)).alias("event_key"), (k % 7).alias("evidence_count"), F.when(k % 2 == 0, "A").otherwise("C").alias("grade"), F.lit(None).cast("string").alias("amount"), F.lit(None).cast("string").alias("summary"),
    ).withColumn("source_url", F.col("url"))
    of = lambda s: rows.where(F.col("o_orderstatus") == s)
    told = of("O").withColumn("status", F.when(F.col("pos") % 4 == 0, "verified").otherwise("pending"))
    known = of("F").where("pos % 2 = 0").select(F.col("organization").alias("company"), F.when(F.col("category") == lx.FINANCING, F.coalesce("financing_round", F.lit("Pre-A轮"))).alias("round_name"), F.col("published_us").alias("announced_us"))
    found = signals.surfaced(told, of("P").withColumn("item_id", F.col("pos").cast("string")), of("F").where("pos % 2 = 1"), known)
    return found.select("branch", F.col("pos").alias("first_pos"), "title", "label", F.array_join("source_urls", ",").alias("urls"), "identity")


# --------------------------------------------------------------------- report rows
_TYPE_OF = {"view": "procurement_intention", "click": "tender", "signup": "candidate", "purchase": "award", "error": "change"}


@query(f"""WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 20 DAY END AS d, event_id % 2 = 0 AS by_date, event_id % 5 <> 0 AS evidenced FROM events)
 SELECT event_id, CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN 'results' WHEN d IS NOT NULL AND CASE WHEN by_date THEN CAST({NOW_SQL} AS DATE) > CAST(d AS DATE) ELSE {NOW_SQL} > d END THEN 'results' WHEN d IS NOT NULL AND evidenced THEN 'opportunities' ELSE 'confirmation' END AS grp FROM e""")
def procurement_stage_groups(spark, sf):
    """Open notices with evidenced deadlines ahead are opportunities, other open ones want confirmation, the rest are results."""
    due = F.when(F.col("event_id") % 3 != 0, F.col("ts") + F.make_dt_interval(F.lit(20)))
    grp = report.procurement_group(lx.mapped(F.col("event_type"), _TYPE_OF, F.lit("other")), F.lit(None).cast("string"), due, F.when(F.col("event_id") % 2 == 0, "date").otherwise("minute"), F.col("event_id") % 5 != 0, now())
    return table(spark, sf, "events").select("event_id", grp.alias("grp"))


@query(f"""SELECT user_id, '- ' || strftime(max(ts), '%Y-%m-%d') || '｜c｜u\\_' || user_id || '｜采购单位：x｜状态：open｜[查看原始公告](http://e/' || arg_max(event_id, struct_pack(a := ts, b := event_id)) || ')' AS line,
 string_agg('[' || {_STAGE_SQL} || '](http://e/' || event_id || ')（' || strftime(ts, '%Y-%m-%d') || '）', ' → ' ORDER BY ts, event_id) AS chain FROM events GROUP BY user_id""")
def project_lines(spark, sf):
    e = staged(spark, sf).select(F.col("user_id").alias("project_id"), "event_id", F.col("stage").alias("event_type"), F.col("ts").alias("published_at"), F.concat(F.lit("http://e/"), F.col("event_id").cast("string")).alias("source_url"))
    p = e.select("project_id").distinct().select("project_id", F.concat(F.lit("u_"), F.col("project_id").cast("string")).alias("name"), F.lit("x").alias("organization"), F.lit("c").alias("category"), F.lit("open").alias("status"))
    return report.project_lines(p, e).withColumnRenamed("project_id", "user_id")


@query(f"""WITH l AS (SELECT user_id, max(ts) AS latest_at, arg_max({_STAGE_SQL}, struct_pack(a := ts, b := event_id)) AS stage FROM events GROUP BY 1)
 SELECT user_id, latest_at, stage IN ('award', 'failed') AS completed FROM l WHERE latest_at BETWEEN TIMESTAMP '2024-01-25 00:00:00' AND {NOW_SQL}""")
def rolling_projects(spark, sf):
    e = staged(spark, sf).select(F.col("user_id").alias("project_id"), "event_id", F.col("stage").alias("event_type"), F.col("ts").alias("published_at"))
    p = e.select("project_id").distinct().select("project_id", F.lit("open").alias("status"), F.lit(None).cast("timestamp_ntz").alias("latest_event_at"), F.lit(None).cast("string").alias("current_stage"))
    return report.rolling(p, e, F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'"), now()).withColumnRenamed("project_id", "user_id")


@query("SELECT '统计期内共有' || sum(n) || '条已核验事件：' || string_agg(event_type || ' ' || n || '条', '、' ORDER BY event_type) || '。' AS summary FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)")
def trend_sentence(spark, sf):
    return report.trend_sentence(table(spark, sf, "events").groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("n")))


@query("""SELECT o_custkey, arg_max(o_orderpriority, struct_pack(t := CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, p := o_orderdate, n := length(o_orderpriority), x := o_orderpriority)) AS title, max(o_orderdate) AS published_at, array_to_string(list_sort(list(DISTINCT 'http://' || o_orderstatus)), ',') AS sources,
 CASE WHEN count(DISTINCT o_orderstatus) >= 2 OR bool_or(o_orderstatus = 'F') THEN 'high_confidence' ELSE 'candidate' END AS label FROM orders GROUP BY 1""")
def merged_signals(spark, sf):
    """Orders of a customer as leads of one financing, merged."""
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("leader"), F.col("o_orderpriority").alias("title"), F.lit("x").alias("organization"), F.col("o_orderdate").cast("timestamp").alias("published_at"), F.lit("").alias("amount"), F.lit("A").alias("round_name"), F.lit("").alias("summary"), F.when(F.col("o_orderstatus") == "F", "high_confidence").otherwise("candidate").alias("label"), F.array(F.concat(F.lit("http://"), F.col("o_orderstatus"))).alias("source_urls"))
    return report.merged_signals(rows).select(F.col("leader").alias("o_custkey"), "title", F.col("published_at").cast("timestamp_ntz").alias("published_at"), F.array_join("source_urls", ",").alias("sources"), "label")


@query()
def lead_groups(spark, sf):
    """Orders of a customer as leads of one event where round and dates fit, greedily, newest first; each group with its key."""
    day = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("long")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"), F.lit(lx.FINANCING).alias("category"), F.lit("financing").alias("event_type"), F.array(F.col("o_custkey").cast("string")).alias("aliases"), day.alias("day"), F.array(F.col("o_orderstatus")).alias("rounds"), F.lit(None).cast("string").alias("amount"), F.array().cast("array<string>").alias("investors"), F.lit("").alias("title_key"), (-day).alias("newest"))
    return followup.group_keys(rows, followup.group_targets(rows, "pos", ["newest"]), "pos")
