"""Unverified signals against plain Python restatements of the three branches and of the merge."""

import random
import re

from gleaner.operators import signals
from gleaner.operators.report import same_signal

FIN, DAY = "commercial_space_financing", 86_400_000_000
DIAG = "pos long, status string, category string, title string, organization string, financing_round string, published_us long, source_url string, event_key string, evidence_count long, grade string, amount string, summary string"
PEND = "pos long, item_id string, title string, category string, source_url string, published_us long"
CAND = "pos long, title string, category string, url string, published_us long"
DONE = "company string, round_name string, announced_us long"


def identity(x):
    return re.sub(r"[^\w+]+", "", (x or "").lower())


def rounds(x):
    return {re.sub(r"[\s-]+", "", m.lower()) for m in re.findall(r"(?i)(pre[\s-]?[a-d]\+{0,2}|[a-d]\+{0,2}|天使\+{0,2}|种子|战略投资|战略)\s*轮", x or "")}


def day(us):
    return None if us is None else (us + 8 * 3_600_000_000) // DAY


def hidden(category, org, title, round_name, us, done):
    if category != FIN:
        return False
    mine = rounds(round_name or title)
    for company, theirs, at in done:
        if not identity(company) or identity(company) not in identity(f"{org or ''} {title}"):
            continue
        own = rounds(theirs)
        if own and not own & mine:
            continue
        if us is not None and abs(day(us) - day(at)) > 45:
            continue
        return True
    return False


def plain_surfaced(diag, pend, cand, done):
    groups, out = {}, []
    for d in sorted(diag):
        pos, status, cat, title, org, rnd, us, url, key, n, grade, amount, summary = d
        if status == "pending" and cat is not None and not hidden(cat, org, title, rnd, us, done):
            groups.setdefault(key or "|".join((cat, org or "", rnd or "", title)), []).append(d)
    seen = set()
    for key, rows in groups.items():
        r = max(rows, key=lambda d: (d[9], d[10] in ("A", "B"), d[7]))
        urls = sorted({d[7] for d in rows})
        seen.update(urls)
        strong = len(urls) >= 2 or any(d[10] in ("A", "B") and d[9] >= 5 for d in rows)
        out.append({"category": r[2], "label": "high_confidence" if strong else "candidate", "title": r[3], "organization": r[4] or "", "published_us": r[6], "amount": r[11] or "", "round_name": r[5] or "", "summary": r[12] or "", "source_urls": urls, "identity": key})
    pool = {p[4] for p in pend}
    for kind, rows in (("pending", [(t, c, u, us, f"pending:{i}") for _, i, t, c, u, us in sorted(pend)]), ("candidate", [(t, c, u, us, f"candidate:{u}") for _, t, c, u, us in sorted(cand)])):
        for title, cat, url, us, key in rows:
            if cat is None or url in seen or (kind == "candidate" and url in pool) or hidden(cat, "", title, "", us, done):
                continue
            seen.add(url)
            out.append({"category": cat, "label": "candidate", "title": title, "organization": "", "published_us": us, "amount": "", "round_name": "", "summary": "", "source_urls": [url], "identity": key})
    return out


def lead(s):
    return {"subject": identity(s["organization"] or s["title"]), "rounds": rounds(s["round_name"] or s["title"]), "amount": "=" + identity(s["amount"]) if s["amount"] else None, "day": day(s["published_us"])}


def plain_merged(found):
    kept = []
    for s in found:
        at = next((i for i, x in enumerate(kept) if s["category"] == x["category"] == FIN and same_signal(lead(x), lead(s))), None)
        if at is None:
            kept.append(s)
            continue
        a = kept[at]
        speaker = max((a, s), key=lambda x: (x["label"] == "high_confidence", len(x["organization"]), x["published_us"] or 0, len(x["title"])))
        urls = sorted({*a["source_urls"], *s["source_urls"]})
        kept[at] = {
            "category": FIN, "label": "high_confidence" if len(urls) >= 2 or "high_confidence" in (a["label"], s["label"]) else "candidate", "title": speaker["title"], "organization": max(a["organization"], s["organization"], key=len),
            "published_us": max((x["published_us"] for x in (a, s) if x["published_us"] is not None), default=None), "amount": speaker["amount"] or a["amount"] or s["amount"], "round_name": max(a["round_name"], s["round_name"], key=len),
            "summary": speaker["summary"] or a["summary"] or s["summary"], "source_urls": urls, "identity": f"{a['identity']}||{s['identity']}",
        }
    return sorted(kept, key=lambda s: (s["label"] != "high_confidence", -(s["published_us"] or 0), s["identity"]))


def test_signals_against_plain_python(spark):
    rng = random.Random(3)
    firms = ["天穹", "天穹火箭", "星海", "星海卫星科技", "Orbit X", "甲"]
    when = lambda: rng.choice([None, *(rng.randrange(0, 200 * DAY) for _ in range(6))])
    url = lambda: f"http://s/{rng.randrange(70)}"
    cat = lambda: rng.choice([None, FIN, FIN, FIN, FIN, "eo_turret"])
    title = lambda: f"{rng.choice(firms)}{rng.choice(['完成', '宣布 '])}{rng.choice(['A轮', 'B+轮', 'Pre-A轮', 'A轮、B+轮', ''])}融资{rng.randrange(3)}"
    diag = [(i, rng.choice(["pending", "pending", "verified"]), cat(), title(), rng.choice([None, "", *firms]), rng.choice([None, "", "A轮", "B+ 轮", "A轮和B+轮"]), when(), url(), rng.choice([None, f"e{rng.randrange(12)}"]), rng.randrange(8), rng.choice([None, *"ABC"]), rng.choice([None, "", "1亿", "2 亿", "——"]), rng.choice([None, "s", "摘要"])) for i in range(90)]
    pend = [(i, f"i{i}", title(), cat(), url(), when()) for i in range(50)]
    cand = [(i, title(), cat(), url(), when()) for i in range(50)]
    done = [(rng.choice([*firms[2:], "无关"]), rng.choice([None, "A轮", "B+轮"]), rng.randrange(0, 200 * DAY)) for _ in range(5)]
    frames = [spark.createDataFrame(rows, schema).repartition(3) for rows, schema in ((diag, DIAG), (pend, PEND), (cand, CAND), (done, DONE))]
    names = [x.split(" ")[0] for x in signals._SIGNAL.split(", ")]
    want = plain_surfaced(diag, pend, cand, done)
    got = [r.asDict() for r in signals.surfaced(*frames).orderBy("branch", "pos").collect()]
    assert [{c: r[c] for c in names} for r in got] == want and len(want) > 40
    final = [r.asDict() for r in signals.unverified(*frames).orderBy(*signals.in_order()).collect()]
    plain = plain_merged(want)
    assert final == plain and len(plain) < len(want) - 5
    empty = [f.limit(0) for f in frames]
    assert signals.unverified(*empty).collect() == []
