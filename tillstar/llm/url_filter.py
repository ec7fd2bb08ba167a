"""URL verdicts from rules and, where no rule fits, from a character language-model ratio.

Rules are (verdict, host, path) and fit the host and its subdomains where the path starts with
the rule's; the longest rule wins. Every URL that a rule decides trains one of two smoothed
variable-order Markov models of characters, accepted or rejected. Counts of each character
after up to ``order`` characters before it cover all those URLs. A context belongs to a model
if at least ``LEAST`` characters follow it, at every size of the input. Longer contexts are
smoothed with shorter ones (Witten-Bell).

The models grow with the input, so they are stored tables and never held in one process. Every
distinct stretch of ``order`` + 1 characters gets its ratio once, from short contexts to long
ones; the stretches of the distinct URLs, counted within each URL, are then joined with it.

A URL is blocked if its log-likelihood under the rejected model exceeds that under the accepted
one by more than the threshold per character. The threshold is the one with the best balanced
accuracy over the rule-decided URLs of a fold that the counts leave out; without both classes
nothing is blocked.

Null URLs and those without "://" have empty host and path, fit no rule and are scored by what
they hold; an empty URL scores zero. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 5
LEAST = 2
# Only the plain model of the tests reads it, which at its size comes to LEAST.
CONTEXT_SHARE = 20_000
# Stretches that a task hands on at once.
HANDED = 100_000
ALPHABET = 256
START = "\x02"
# Steps of the ratio in which the threshold is chosen, and its furthest value.
STEP, FURTHEST = 0.01, 5.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    text = F.coalesce(url, F.lit(""))
    after = F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, "(?s)^.*?://", ""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(
        F.regexp_extract(after, r"(?s)^[^/?#]*", 0),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def decided(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits as text (host and path), and its verdict; null if none."""
    rule = verdict = F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(
            path, F.lit(start)
        )
        rule = F.when(fits, own + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _stretches(urls: DataFrame, order: int) -> DataFrame:
    """(key, g, n, allow, block) of the distinct ``urls``: how often each stretch of ``order`` + 1
    characters is in a URL, and how often in all rows of it that one of the models learns from."""
    schema = pa.schema(
        [("key", pa.binary()), ("g", pa.string())] + [(c, pa.int64()) for c in ("n", "allow", "block")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            names = ("key", "url", "allow", "block")
            for key, url, allow, block in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                padded = START * order + url
                held = Counter(padded[k : k + order + 1] for k in range(len(url)))
                rows += [(key, g, n, n * allow, n * block) for g, n in held.items()]
                if len(rows) >= HANDED:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)

    some = urls.filter("url <> ''").select("key", "url", "allow", "block")
    return some.mapInArrow(run, "key binary, g string, n long, allow long, block long")


def _contexts(stretches: DataFrame, order: int) -> DataFrame:
    """(context, char) of every length with its counts, and the sum and number of the characters
    that follow the context, for both models."""
    # Equal stretches are counted before they are taken apart into contexts of every length.
    long = stretches.groupBy("g").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    long = stored(long, "url-stretches")
    each = long.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(order))))
    counts = each.groupBy(
        F.expr(f"substr(g, {order + 1} - k, k)").alias("context"),
        F.expr(f"substr(g, {order + 1}, 1)").alias("char"),
    ).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    counts = stored(counts, "url-counts")
    totals = counts.groupBy("context").agg(
        *[F.sum(v).alias(f"{v}_total") for v in ("allow", "block")],
        *[F.count_if(F.col(v) > 0).alias(f"{v}_kinds") for v in ("allow", "block")],
    )
    return stored(counts.join(stored(totals, "url-totals"), "context"), "url-contexts")


def _ratios(contexts: DataFrame, order: int) -> DataFrame:
    """(g, ratio): log-likelihood of rejection against acceptance of each stretch's last
    character; null if a model has no URLs."""

    def smoothed(verdict: str, shorter: Column) -> Column:
        total, kinds = F.col(f"{verdict}_total"), F.col(f"{verdict}_kinds")
        return (F.col(verdict) + kinds * shorter) / (total + kinds)

    verdicts = ("allow", "block")
    rows = contexts.filter("context = ''")
    both = (F.col("allow_total") > 0) & (F.col("block_total") > 0)
    first = [F.when(both, smoothed(v, F.lit(1 / ALPHABET))).alias(f"{v}_chance") for v in verdicts]
    chances = rows.select("context", "char", *first)
    for k in range(1, order + 1):
        # A stretch is followed up by no more longer ones than there are characters.
        shorter = chances.withColumnRenamed("context", "tail")
        rows = contexts.filter(F.length("context") == k)
        rows = rows.withColumn("tail", F.expr("substr(context, 2)")).join(shorter, ["tail", "char"])
        longer = [
            F.when(F.col(f"{v}_total") >= LEAST, smoothed(v, F.col(f"{v}_chance")))
            .otherwise(F.col(f"{v}_chance"))
            .alias(f"{v}_chance")
            for v in verdicts
        ]
        chances = rows.select("context", "char", *longer)
    ratio = F.ln("block_chance") - F.ln("allow_chance")
    return chances.select(F.concat("context", "char").alias("g"), ratio.alias("ratio"))


def _scored(pages: DataFrame, order: int) -> DataFrame:
    """(key, verdict, aside, rows, score) of the distinct URLs of ``pages`` (key, url, verdict)."""
    aside = F.crc32("url") % 5 == 0
    urls = pages.filter("url is not null").groupBy("key", "url", "verdict").agg(
        F.count(F.lit(1)).alias("rows")
    )
    learned = [
        F.when((F.col("verdict") == v) & ~aside, F.col("rows")).otherwise(0).alias(v)
        for v in ("allow", "block")
    ]
    urls = stored(urls.select("*", aside.alias("aside"), *learned), "urls")
    stretches = _stretches(urls, order)
    # Stored, so that the join deals both sides anew and can split the rows of a hot stretch.
    ratios = stored(_ratios(_contexts(stretches, order), order), "url-ratios")
    # Sums of decimals do not depend on their order.
    ratio = (F.col("n") * F.col("ratio")).cast("decimal(28,12)")
    sums = stretches.join(ratios, "g").groupBy("key").agg(F.sum(ratio).alias("sum"))
    score = F.col("sum").cast("double") / F.length("url")
    scored = urls.join(sums, "key", "left").select(
        "key", "verdict", "aside", "rows", F.coalesce(score, F.lit(0.0)).alias("score")
    )
    return stored(scored, "url-scores")


def _threshold(scored: DataFrame) -> float:
    """The ratio that best parts both verdicts, from counts in small steps."""
    clipped = F.greatest(F.least(F.col("score"), F.lit(FURTHEST)), F.lit(-FURTHEST))
    steps = scored.groupBy(F.floor(clipped / STEP).alias("step"), "verdict")
    steps = steps.agg(F.sum("rows").alias("count")).collect()
    sums = {v: sum(r["count"] for r in steps if r.verdict == v) for v in ("allow", "block")}
    if not all(sums.values()):
        return FURTHEST + 1
    best, passed = (0.0, FURTHEST), {"allow": 0, "block": sums["block"]}
    by_step: dict[int, dict[str, int]] = {}
    for r in steps:
        by_step.setdefault(r.step, {})[r.verdict] = r["count"]
    for step in sorted(by_step):
        passed["allow"] += by_step[step].get("allow", 0)
        passed["block"] -= by_step[step].get("block", 0)
        gain = passed["allow"] / sums["allow"] + passed["block"] / sums["block"]
        best = max(best, (gain, (step + 1) * STEP))
    return best[1]


def judged(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER
) -> DataFrame:
    """One line per row: id, host, path, rule, verdict, score."""
    url = F.col(f"`{url_col}`")
    host, path = parts(url)
    rule, verdict = decided(F.col("host"), F.col("path"), rules)
    pages = df.select(F.col(f"`{id_col}`"), url.alias("url"), host.alias("host"), path.alias("path"))
    pages = pages.withColumn("rule", rule).withColumn("verdict", verdict)
    pages = pages.withColumn("__key", F.unhex(F.md5("url")))
    scored = _scored(pages.select(F.col("__key").alias("key"), "url", "verdict"), order)
    threshold = _threshold(scored.filter("aside and verdict is not null"))
    scored = scored.select(F.col("key").alias("__key"), F.col("score").alias("__score"))
    out = pages.join(scored, "__key", "left")
    score = F.coalesce("__score", F.lit(0.0))
    told = F.when(score > threshold, "block").otherwise("allow")
    return out.select(
        F.col(f"`{id_col}`"),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", told).alias("verdict"),
        score.alias("score"),
    )
