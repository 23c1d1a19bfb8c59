"""Selection of candidates: gates, ranking, de-duplication, top-k with back-fill or quotas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import clock, text, urls
from ..functions import lexicon as lx
from ..sources.shared import stored
from .blocks import fold


@dataclass(frozen=True)
class Lexicon:
    """Term lists of the relevance gate."""

    categories: dict = field(default_factory=lambda: dict(lx.CATEGORY_TERMS))
    events: Sequence[str] = lx.PROCUREMENT_EVENTS
    financing: str = lx.FINANCING
    financing_subjects: Sequence[str] = lx.FINANCING_SUBJECTS
    financing_events: Sequence[str] = lx.FINANCING_EVENTS
    financing_specific: Sequence[str] = lx.FINANCING_SPECIFIC
    financing_actions: Sequence[str] = lx.FINANCING_ACTIONS
    noise: Sequence[str] = (*lx.PRODUCT_NOISE, *lx.RESEARCH_NOISE, *lx.MARKET_NOISE, *lx.NEGATED_EVENTS)
    title_noise: Sequence[str] = lx.ROUNDUP_NOISE
    blocked_domains: Sequence[str] = lx.RESEARCH_DOMAINS
    stages: Sequence[tuple] = lx.STAGES


# Patterns of companies and rounds in titles.
_QUOTED = r"[「『“\"]([^」』”\"]{2,40})[」』”\"]"
_COMPLETED = r"([\x{4e00}-\x{9fff}A-Za-z0-9·]{2,40}?)(?:宣布|正式|已)?完成"
_OBTAINED = r"([\x{4e00}-\x{9fff}A-Za-z0-9·]{2,40}?)(?:宣布|正式|已)?(?:完成|获得|获)"
_COMPANY_LEADS = ("中国商业航天企业", "商业航天企业", "商业航天卫星公司", "商业航天公司", "火箭新锐公司", "航天新锐公司", "卫星公司", "航天企业", "企业")
_COMPANY_LEGAL = ("股份有限公司", "有限责任公司", "科技有限公司", "有限公司")
_COMPANY_CITIES = ("北京", "上海", "深圳", "广州", "天津", "重庆", "合肥", "西安", "成都", "武汉", "南京", "杭州", "苏州")
_ONE = r"pre[\s-]?[a-d]\+{0,2}|[a-d]\+{0,2}|天使\+{0,2}|种子"
_ROUND_NAMED = rf"(?i)({_ONE}|战略投资|战略|新一)\s*轮"
_ROUND_PAIR = rf"(?i)({_ONE})\s*(?:和|及|、|/)\s*({_ONE})\s*轮"
_NOTICE_CODE = r"(?i)(?:项目|采购|招标|公告)?编号[：:\s]*([A-Za-z0-9][A-Za-z0-9._\-/]{4,})"


def _first_group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _drop_start(c: Column, options: Sequence[str]) -> Column:
    """Without the first option that c begins with."""
    return F.regexp_replace(c, f"^(?:{'|'.join(options)})", "")


def _drop_end(c: Column, options: Sequence[str]) -> Column:
    """Without the longest option that c ends with."""
    return F.regexp_replace(c, f"(?:{'|'.join(options)})$", "")


def company(title: Column, summary: Column) -> Column:
    """The financed company named in the title, else in the summary."""
    raw = F.coalesce(*[_first_group(c, p) for c in (title, summary) for p in (_QUOTED, _COMPLETED, _OBTAINED)])
    out = F.regexp_replace(_drop_start(F.lower(raw), _COMPANY_LEADS), "(?:近日|再次|连续)$", "")
    return F.regexp_replace(_drop_start(_drop_end(out, _COMPANY_LEGAL), _COMPANY_CITIES), r"(?U)[\s，,：:丨|]+", "")


def named_rounds(title: Column, summary: Column) -> Column:
    both = F.concat_ws(" ", title, summary)
    found = F.array_union(*[F.concat(F.regexp_extract_all(both, F.lit(_ROUND_NAMED), F.lit(1)), F.regexp_extract_all(both, F.lit(_ROUND_PAIR), F.lit(i))) for i in (1, 2)])
    return F.array_sort(F.array_distinct(F.transform(found, lambda r: F.regexp_replace(F.lower(r), r"[\s\-]+", ""))))


def canonical_title(title: Column) -> Column:
    bare = F.replace(F.regexp_replace(F.lower(title), r"(?U)[\s*｜|_\-—:：·•]+", ""), F.lit("打印版"), F.lit(""))
    return F.regexp_replace(bare, r"(?:中国行业研究网|腾讯新闻|新浪财经|搜狐网|网易新闻|www\.[a-z0-9.-]+)$", "")


def relevance(df: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """df with `category` (given or inferred) and `score`; score is null for rows that the gate rejects.

    Needs title, summary, url, category_hint.
    """
    said, title = F.col("__said"), F.lower("title")
    noise = lx.any_of(said, lexicon.noise) | lx.any_of(title, lexicon.title_noise) | urls.in_domains(urls.host(F.col("url")), lexicon.blocked_domains)
    df = df.withColumn("__said", text.squeezed(F.col("title"), F.col("summary"))).withColumn("__company", company(F.col("title"), F.col("summary")))
    hint = F.col("category_hint")
    subject, event, procured = lx.hits(said, lexicon.financing_subjects), lx.hits(said, lexicon.financing_events), lx.hits(said, lexicon.events)
    specific = F.col("__company").isNotNull() & lx.any_of(said, lexicon.financing_specific)
    category, score = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, terms in reversed(list(lexicon.categories.items())):
        own = lx.hits(said, terms)
        fits = (own > 0) & (procured > 0)
        for known in (hint == name, hint.isNull()):
            category = F.when(known & fits, F.lit(name)).otherwise(category)
            score = F.when(known & fits, own + procured).otherwise(score)
    inferred = hint.isNull() & (subject > 0) & (event > 0)
    stated = (hint == lexicon.financing) & (event > 0) & lx.any_of(title, lexicon.financing_actions) & ((subject > 0) | specific)
    category = F.when(stated | inferred, F.lit(lexicon.financing)).otherwise(category)
    score = F.when(stated, subject + event + F.when(specific, 2).otherwise(0)).when(inferred, subject + event).otherwise(score)
    return df.withColumn("category", F.when(~noise, category)).withColumn("score", F.when(~noise, score)).drop("__said", "__company")


def first_by(df: DataFrame, key: Column, pos: str) -> DataFrame:
    """The first row of each key in input order."""
    w = Window.partitionBy(key).orderBy(pos)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def rank_order(preferred: Sequence[str] = (), source: str = "discovery_source", published: str = "published_at", score: str = "score", url: str = "url") -> list[Column]:
    """Official sources, then preferred domains; newest first, unknown dates last; higher score; URL."""
    tier = F.when(F.col(source).startswith("official:"), 0).when(urls.in_domains(urls.host(F.col(url)), preferred), 1).otherwise(2)
    return [tier.asc(), F.col(published).desc_nulls_last(), F.col(score).desc(), F.col(url).asc()]


def backfill(df: DataFrame, order: list[Column], minimum: int = 5, maximum: int = 10, most_unknown: int = 2, bucket: str = "bucket") -> DataFrame:
    """Recent rows up to the maximum; older ones, then a few undated ones, only up to the minimum.

    At most `maximum` rows of a bucket take part, so the ranks beyond never leave their partitions.
    """
    ranked = df.where(F.col(bucket).isNotNull()).withColumn("__r", F.row_number().over(Window.partitionBy(bucket).orderBy(*order))).where(F.col("__r") <= maximum)
    n = ranked.agg(*[F.count_if(F.col(bucket) == b).alias(b) for b in ("recent", "fallback")])
    room = F.greatest(F.lit(minimum) - F.col("recent"), F.lit(0))
    left = F.greatest(F.lit(minimum) - F.col("recent") - F.least(F.col("fallback"), room), F.lit(0))
    keep = (F.col(bucket) == "recent") | ((F.col(bucket) == "fallback") & (F.col("__r") <= room)) | ((F.col(bucket) == "unknown") & (F.col("__r") <= F.least(left, F.lit(most_unknown))))
    out = ranked.join(F.broadcast(n), how="cross").where(keep)  # n is one row
    place = F.when(F.col(bucket) == "recent", 0).when(F.col(bucket) == "fallback", 1).otherwise(2) * F.lit(1_000_000) + F.col("__r")
    return out.withColumn("place", F.row_number().over(Window.orderBy(place)).cast("long")).drop("__r", "recent", "fallback")


def quota(df: DataFrame, order: list[Column], quota_class: Column, limits: dict[str, int], maximum: int) -> DataFrame:
    """Top rows of each disjoint class within its limit, classes in order, then the best of the rest up to the maximum."""
    classed = df.withColumn("__class", quota_class)
    within = classed.withColumn("__r", F.row_number().over(Window.partitionBy("__class").orderBy(*order)))
    limit = F.lit(0)
    place = F.lit(len(limits))
    for i, (name, n) in enumerate(limits.items()):
        limit = F.when(F.col("__class") == name, n).otherwise(limit)
        place = F.when(F.col("__class") == name, i).otherwise(place)
    # A row beyond max(limit, maximum) of its class can never be chosen.
    within = within.where(F.col("__r") <= maximum + max(limits.values(), default=0))
    chosen = F.col("__r") <= limit
    first = F.when(chosen, place).otherwise(len(limits))
    ranked = within.withColumn("place", F.row_number().over(Window.orderBy(first, *order)).cast("long"))
    return ranked.where(F.col("place") <= maximum).drop("__class", "__r")


def same_event(left: dict, right: dict, financing: str = lx.FINANCING) -> bool:
    """Equal notices: financings by company, rounds and date; else by code, or by stage and title."""
    if left["category"] != right["category"]:
        return False
    if left["category"] == financing and left["company"] and right["company"] and len(left["rounds"]) and len(right["rounds"]):
        if left["company"] != right["company"] or not set(left["rounds"]) & set(right["rounds"]):
            return False
        a, b = left["published_us"], right["published_us"]
        return a is None or b is None or a != a or b != b or abs((int(a) - int(b)) // clock.DAY) <= 14
    if left["code"] and right["code"]:
        return left["code"] == right["code"]
    return left["stage"] == right["stage"] and left["title_key"] == right["title_key"]


def group_events(df: DataFrame, pos: str, order: Sequence[str]) -> DataFrame:
    """(pos, leader) by greedy event equality; rows are held against earlier leaders in rank order.

    Financings of a company with rounds are compared by these alone, so they share a key for each round, and a code or a
    title only where a row that is none of them has it too; else one title would make one block of all companies.
    Needs category, company, rounds, code, stage, title_key, published_us; other columns stay behind.
    """
    tag = lambda kind, *cols: F.when(F.forall(F.array(*[c.isNotNull() for c in cols]), lambda x: x), F.concat_ws("\x01", F.lit(kind), F.coalesce("category", F.lit("")), *cols))
    financing = F.coalesce(F.col("category") == lx.FINANCING, F.lit(False))
    whole = F.coalesce(financing & (F.col("company") != "") & (F.size("rounds") > 0), F.lit(False))
    needed = dict.fromkeys([pos, *order, "category", "company", "rounds", "code", "stage", "title_key", "published_us"])
    rows = df.select(*needed, whole.alias("__whole"), tag("n", F.col("code")).alias("__n"), tag("t", F.col("stage"), F.col("title_key")).alias("__t"))
    others = rows.where(financing & ~F.col("__whole"))
    if others.isEmpty():
        rows = rows.withColumns({k: F.when(~F.col("__whole"), F.col(k)) for k in ("__n", "__t")})
    else:
        for k in ("__n", "__t"):
            held = others.where(F.col(k).isNotNull()).select(F.col(k).alias("__k")).distinct()
            rows = rows.join(held, F.col(k) == F.col("__k"), "left").withColumn(k, F.when(~F.col("__whole") | F.col("__k").isNotNull(), F.col(k))).drop("__k")
    named = F.when(F.col("__whole"), F.transform("rounds", lambda r: tag("c", F.col("company"), r))).otherwise(F.array().cast("array<string>"))
    return fold(rows, pos, F.concat(named, F.array("__n", "__t")), order, same_event)


def select_candidates(rows: DataFrame, now: Column, minimum: int = 5, maximum: int = 10, fallback_days: int = 30, preferred: Sequence[str] = (), balanced: bool = False, lexicon: Lexicon = Lexicon()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected rows with `place`, corroborating rows of each, one row of funnel counts).

    rows: input_pos, title, url, summary, category_hint, discovery_source, published_at.
    """
    shaped = relevance(rows.withColumn("__valid", urls.usable_shape(F.col("title"), F.col("summary"), F.col("url"))), lexicon)
    # The funnel is counted in the pass that writes the rows behind the gate; no second pass, and no sort repeats the gate.
    funnel = Observation()
    counted = shaped.observe(
        funnel, F.count(F.lit(1)).alias("raw"), F.count_if("__valid").alias("valid"), F.count_if(F.expr("__valid and score is not null")).alias("relevant"),
        F.count_if(F.expr("__valid and score is null")).alias("rejected"),
    )
    passed = stored(counted.where("__valid and score is not null").withColumn("url", urls.normalize_url(F.col("url"))), "relevant-candidates")
    unique = first_by(passed, F.col("url"), "input_pos")
    dated = unique.where(clock.within(F.col("published_at"), now, fallback_days)).withColumn("bucket", clock.bucket(F.col("published_at"), now, 7, fallback_days))
    said, dated = F.col("__said"), dated.withColumn("__said", text.squeezed(F.col("title"), F.col("summary")))
    # A sort over ranges, not one window over all rows, ranks the candidates; storing them fixes their places.
    keyed = dated.orderBy(*rank_order(preferred)).select(
        "*", company(F.col("title"), F.col("summary")).alias("company"), named_rounds(F.col("title"), F.col("summary")).alias("rounds"),
        F.lower(_first_group(F.concat_ws(" ", "title", "summary"), _NOTICE_CODE)).alias("code"), lx.first_label(said, lexicon.stages, "unknown").alias("stage"),
        canonical_title(F.col("title")).alias("title_key"), F.unix_micros(F.col("published_at").cast("timestamp")).alias("published_us"),
        F.monotonically_increasing_id().alias("rank_pos"),  # ascends along the sort; only the order matters
    )
    keyed = stored(keyed, "ranked-candidates")
    groups = stored(group_events(keyed, "rank_pos", ["rank_pos"]), "event-groups")
    joined = keyed.join(groups.withColumnRenamed("pos", "rank_pos"), "rank_pos")
    primary = joined.where("leader = rank_pos")
    order = rank_order(preferred)
    if balanced:
        names = list(lexicon.categories)
        klass = F.when(F.col("category") == lexicon.financing, F.lit("f"))
        for c in names:
            klass = klass.when((F.col("category") == c) & F.col("stage").isin("intention", "tender", "change"), F.lit(f"o{c}"))
        for c in names:
            klass = klass.when((F.col("category") == c) & F.col("stage").isin("candidate", "award", "termination", "delivery"), F.lit(f"r{c}"))
        bucketed = [F.when(F.col("bucket") == "recent", 0).when(F.col("bucket") == "fallback", 1).otherwise(2).asc(), *order]
        chosen = quota(primary, bucketed, klass, {"f": 3, **{f"o{c}": 2 for c in names}, **{f"r{c}": 2 for c in names}}, maximum)
    else:
        chosen = backfill(primary, order, minimum, maximum)
    extra = corroborating(joined.where("leader <> rank_pos").join(chosen.select(F.col("rank_pos").alias("leader"), F.col("url").alias("primary_url"), "place"), "leader"))
    seen = [F.lit(funnel.get[c]).cast("long").alias(c) for c in ("raw", "valid", "relevant", "rejected")]
    duplicates = groups.agg(F.count_if(F.expr("leader <> pos")).alias("duplicates"))
    counts = chosen.agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in ("recent", "fallback", "unknown")]).select(*seen, "*").join(duplicates, how="cross")  # one row each
    return chosen, extra, counts


def corroborating(df: DataFrame, most: int = 2) -> DataFrame:
    """At most `most` other sources of each primary, hosts not seen yet first, each in rank order.

    Needs place, primary_url, url, rank_pos.  The first row of each new host comes before further rows of known hosts.
    """
    hosted = df.withColumn("__host", urls.host(F.col("url"))).withColumn("__first", F.row_number().over(Window.partitionBy("place", "__host").orderBy("rank_pos")))
    fresh = (F.col("__first") == 1) & (F.col("__host") != urls.host(F.col("primary_url"))) & (F.col("__host") != "")
    ranked = hosted.withColumn("extra", F.row_number().over(Window.partitionBy("place").orderBy(F.when(fresh, 0).otherwise(1), "rank_pos")).cast("long"))
    return ranked.where(F.col("extra") <= most).drop("__host", "__first")
