"""Search planning: which texts to search for next, within a budget; checks of what a model asks for; time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Which projects rest, what a search may want, and the scope that every search states.
RESTING = ("completed", "closed", "cancelled", "terminated")
SCOPE = "中国境内"
KINDS = (("project_followup", "采购 招标 中标"), ("rolling_recheck", "变更 延期 终止"))
OVERDUE = ("overdue_result", "中标 结果 流标 重新招标")
WINDOW_DAYS = {"daily": 30}
LONGEST_QUERY = 300


def window_start(now: Column, mode: str, other_days: int = 90) -> Column:
    return now - F.make_dt_interval(F.lit(WINDOW_DAYS.get(mode, other_days)))


def in_window(ts: Column, now: Column, mode: str) -> Column:
    """Undated rows pass; others lie between the start of the window and a day from now."""
    return ts.isNull() | ts.between(window_start(now, mode), now + F.make_dt_interval(F.lit(1)))


def project_queries(projects: DataFrame, overdue: Column) -> DataFrame:
    """(pos, n, kind, text, category): two searches per active project, a third one where its result is overdue.

    projects: pos, project_id, name, organization, category, status.
    """
    name = F.concat_ws(" ", "name", "organization", "project_id")
    asked = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(k).alias("kind"), F.concat(name, F.lit(" "), F.lit(t)).alias("text")) for i, (k, t) in enumerate(KINDS)])
    late = F.struct(F.lit(len(KINDS)).alias("n"), F.lit(OVERDUE[0]).alias("kind"), F.concat(name, F.lit(" "), F.lit(OVERDUE[1])).alias("text"))
    active = projects.where(~F.lower("status").isin(*RESTING))
    return active.select("pos", "category", F.explode(F.concat(asked, F.when(F.coalesce(overdue, F.lit(False)), F.array(late)).otherwise(F.array().cast("array<struct<n:int,kind:string,text:string>>")))).alias("q")).select("pos", "q.n", "q.kind", "q.text", "category")


def planned(branches: Sequence[DataFrame], budget: int, scope: str = SCOPE) -> DataFrame:
    """(place, kind, text, category): branches (pos, n, kind, text, category) in order of priority, cut to the budget."""
    every = None
    for i, b in enumerate(branches):
        b = b.select(F.lit(i).alias("branch"), "pos", "n", "kind", "text", "category")
        every = b if every is None else every.unionByName(b)
    order = ["branch", "pos", "n", "text"]
    top = every.orderBy(*order).limit(budget)  # the budget is the feature
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"), "kind", F.concat("text", F.lit(" " + scope)).alias("text"), "category")


def checked_query(query: Column, category: Column, intent: Column, categories: Sequence[str], intents: Sequence[str], noise: Sequence[str], period: str | None = None, scope: str = SCOPE) -> Column:
    """(text, failure) of a search that a model asks for: the text with its period and scope, or why it is refused."""
    tidy = F.trim(F.regexp_replace(F.coalesce(query, F.lit("")), r"(?U)\s+", " "))
    about = F.lit(False)
    for term in noise:
        about |= F.lower(tidy).contains(term.lower())
    failure = (
        F.when((tidy == "") | (F.char_length(tidy) > LONGEST_QUERY), "length")
        .when(~F.coalesce(category.isin(*categories), F.lit(False)), "category")
        .when(about, "out_of_scope_topic")
        .when(~F.coalesce(intent.isin("seed", *intents), F.lit(False)), "intent")
    )
    text = tidy
    for part in (period, scope):
        if part:
            text = F.when(text.contains(part), text).otherwise(F.concat(text, F.lit(" " + part)))
    return F.struct(F.when(failure.isNull(), text).alias("text"), failure.alias("failure"))


def tool_call(name: Column, arguments: Column, categories: Sequence[str], intents: Sequence[str], wanted: str = "search_web") -> Column:
    """(query, category, intent, failure) of a model's call, landed as its name and its JSON arguments."""
    a = F.from_json(arguments, "query string, category string, intent string")
    kinds = [F.get_json_object(arguments, f"$.{f}").isNotNull() for f in ("query", "category", "intent")]
    # A JSON number or object would be read as text: only quoted values are strings.
    quoted = [arguments.rlike(rf'"{f}"\s*:\s*"') for f in ("query", "category", "intent")]
    good = a["category"].isin(*categories) & a["intent"].isin(*intents)
    for c in (*kinds, *quoted):
        good &= c
    failure = F.when(F.coalesce(name != wanted, F.lit(True)), "unsupported_tool").when(~F.coalesce(good, F.lit(False)), "invalid_arguments")
    pick = lambda f: F.when(failure.isNull(), a[f]).alias(f)
    return F.struct(pick("query"), pick("category"), pick("intent"), failure.alias("failure"))


def compacted(candidates: DataFrame, title: int = 240, summary: int = 500) -> DataFrame:
    """Candidates as a prompt shows them: titles and summaries cut."""
    return candidates.select(F.substring("title", 1, title).alias("title"), "url", F.substring("summary", 1, summary).alias("summary"), F.col("category_hint").alias("category"), "published_at")


def new_urls(results: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Results whose URL is not known yet, each URL once."""
    return results.join(known.select(url).distinct(), url, "left_anti").dropDuplicates([url])
