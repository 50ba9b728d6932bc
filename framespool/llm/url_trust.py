"""URL filter: host rules first, then trust and distrust carried over the links between hosts.

judge_pages() gives each page the verdict of the longest rule that fits its url. Where no rule fits, the page's
host decides: personalised PageRank from the hosts whose pages the rules allow (trust) against PageRank over the
reversed edges from the hosts whose pages they block (distrust; who links to bad hosts is suspect).
A host is blocked if its distrust exceeds `ratio` times its trust, else allowed; scores are rounded only where shown. Both
walks go on together, for ROUNDS links at most: after these less than 1e-9 of the weight is left to move, whatever the
links, and a host that is reached by longer ways only has neither trust nor distrust. Hosts with more than HUB links are
dealt out.

Cases: null or scheme-less urls have an empty host and path, get no rule and no links, and are allowed. Null html has
no links. Repeated rows are judged one by one; a link counts once per pair of hosts. An empty table gives an empty
result. Columns besides page_id, url and html are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, checkpointed, split_join, table

#: (rule, verdict); a rule is host/path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ROUNDS, DAMPING, RATIO = 128, 0.85, 1.0
#: Rounds from one checkpoint to the next.
STEP = 3
#: Links of a host that one task follows.
HUB = 100_000
LINK = r"(?i)\b(?:href|src)\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s<>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: from there up to ? or #."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = url.substr(F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def rank(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRanks, one for each way. edges: (way, src, dst) distinct; seeds: (way, host, weight), weights that sum
    to 1 in each way. Returns (way, host, score).

    Mass that reaches a host without out-links is not handed out again. A round moves what the last one added; rounds end
    when nothing is left to move, and after `rounds`. Partial sums by destination go before the shuffle, and every STEP
    rounds are checkpointed, so a lost executor costs these at most."""
    degree = checkpointed(edges.groupBy("way", "src").agg(F.count("*").alias("links")).withColumn("parts", F.ceil(F.col("links") / HUB).cast("int")))
    edges = checkpointed(split_join(edges, degree, ["way", "src"], "links").withColumn("part", F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int")))
    degree = degree.select("way", F.col("src").alias("host"), "parts")
    own = ((1 - damping) * F.col("weight")).alias("score")
    state = checkpointed(seeds.select("way", "host", own, own.alias("added")))
    none = F.lit(0.0)
    for done in range(0, rounds, STEP):
        for _ in range(min(STEP, rounds - done)):
            moving = state.filter("added > 0").join(degree, ["way", "host"])
            moving = moving.select("way", F.col("host").alias("src"), "added", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            moved = edges.join(moving, ["way", "src", "part"]).select("way", F.col("dst").alias("host"), none.alias("score"), (damping * F.col("added") / F.col("links")).alias("added"))
            both = state.select("way", "host", "score", none.alias("added")).unionByName(moved).groupBy("way", "host")
            state = both.agg((F.sum("score") + F.sum("added")).alias("score"), F.sum("added").alias("added"))
        state = checkpointed(state)
        if state.filter("added > 0").isEmpty():
            break
    return state.select("way", "host", "score")


def host_scores(pages: DataFrame, damping: float = DAMPING, rules=RULES, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) of every host that the seeds reach. pages: host, path, html."""
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    seen = pages.filter("host <> ''").select("host", verdict.alias("says")).groupBy("host").agg(
        F.count_if(F.col("says") == "allow").alias("good"), F.count_if(F.col("says") == "block").alias("bad")
    )
    seen = checkpointed(seen)
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    edges = (
        pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("to"))
        .select("src", F.translate("to", UPPER, LOWER).alias("dst")).filter("src <> dst").distinct()
    )
    edges = checkpointed(edges)
    ways = edges.select(F.lit("trust").alias("way"), "src", "dst").unionByName(edges.select(F.lit("distrust").alias("way"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    seeds = None
    for way, kind in (("trust", "good"), ("distrust", "bad")):
        total = seen.agg(F.sum(kind)).first()[0] or 1
        part = seen.filter(F.col(kind) > 0).select(F.lit(way).alias("way"), "host", (F.col(kind) / F.lit(float(total))).alias("weight"))
        seeds = part if seeds is None else seeds.unionByName(part)
    score = lambda way: F.coalesce(F.sum(F.when(F.col("way") == way, F.col("score"))), F.lit(0.0)).alias(way)
    return rank(ways, seeds, damping, rounds).groupBy("host").agg(score("trust"), score("distrust"))


def judge_pages(pages: DataFrame, rules=RULES, damping: float = DAMPING, ratio: float = RATIO, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of pages."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    scores = host_scores(pages, damping, rules, rounds)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when(distrust > ratio * trust, "block").otherwise("allow")
    return pages.drop("html").join(scores, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.round(trust, 6).alias("trust"), F.round(distrust, 6).alias("distrust")
    )


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"))


def _sql() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[0]))
    fits = [f"((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}'))" for h, _, p in (r[0].partition("/") for r in rules)]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r[0]}'" for f, r in zip(fits, rules)) + " END"
    says = "CASE " + " ".join(f"WHEN {f} THEN '{r[1]}'" for f, r in zip(fits, rules)) + " END"
    link = LINK.replace("'", "''")
    parts = [
        f"""p0 AS MATERIALIZED (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS MATERIALIZED (SELECT page_id, html, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p0),
r AS MATERIALIZED (SELECT page_id, html, host, path, {rule} AS rule, {says} AS says FROM p),
seen AS MATERIALIZED (SELECT host, count(*) FILTER (says = 'allow') AS good, count(*) FILTER (says = 'block') AS bad FROM r WHERE host <> '' GROUP BY host),
e AS MATERIALIZED (SELECT DISTINCT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM r WHERE host <> '') WHERE src <> dst)"""
    ]
    for name, kind, src, dst in (("t", "good", "src", "dst"), ("d", "bad", "dst", "src")):
        parts.append(f"{name}e AS MATERIALIZED (SELECT {src} AS src, {dst} AS dst, count(*) OVER (PARTITION BY {src}) AS links FROM e)")
        parts.append(f"{name}s AS MATERIALIZED (SELECT host, {kind} / (SELECT sum({kind}) FROM seen) AS weight FROM seen WHERE {kind} > 0)")
        parts.append(
            f"{name}w AS (SELECT host, (1 - {DAMPING})::DOUBLE * weight AS score, 0 AS k FROM {name}s UNION ALL"
            f" SELECT dst, sum({DAMPING} * score / links), k + 1 FROM {name}w JOIN {name}e ON src = host WHERE k < {ROUNDS} GROUP BY dst, k)"
        )
        parts.append(f"{name}r AS MATERIALIZED (SELECT host, sum(score) AS score FROM {name}w GROUP BY host)")
    trust, distrust = "coalesce(tr.score, 0)", "coalesce(dr.score, 0)"
    return (
        "WITH RECURSIVE " + ",\n".join(parts)
        + f"\nSELECT page_id, r.host, path, rule, coalesce(says, CASE WHEN {distrust} > {RATIO} * {trust} THEN 'block' ELSE 'allow' END) AS verdict, round({trust}, 6) AS trust, round({distrust}, 6) AS distrust"
        + " FROM r LEFT JOIN tr ON r.host = tr.host LEFT JOIN dr ON r.host = dr.host"
    )


QUERIES = {"op1_url_trust": op1_url_trust}
SQL = {"op1_url_trust": _sql()}
