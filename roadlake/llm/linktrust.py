"""URL filters by rules and, where no rule fits, by trust and distrust along links between hosts.

A host's trust seed is the share of its pages that an allow rule fits, its distrust seed the
share that a block rule fits. Trust follows links (personalised PageRank from the trusted
seeds). Distrust runs against them, from the blocked seeds to the hosts that link there, by the
share of the linking host's links: it is the part of a (damped) walk out of the host, stopped
at pages with a rule, that ends at blocked ones. So it does not shrink with the number of hosts
that link to the same place, and cycles cannot raise it above 1. A host is blocked when its
distrust reaches `THRESHOLD` and is above its trust.

Links within a host carry nothing. Edges are summed per pair of hosts on the map side, scores
spread by joins, and every few rounds they are written so that plans stay short. The edges of
a host with very many are dealt out to pieces, and its score goes to each of them.

Defined results: a null url or one without `://` has an empty host and path, fits no rule, and
is allowed; null html has no links; repeated pages count each; hosts nobody links to have
their seeds only; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.tables import stored

# (host and path prefix, verdict); a rule fits its host and all subdomains.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING = 0.85
ROUNDS = 20
THRESHOLD = 0.5  # most of a host's links lead to blocked hosts, or a few steps on
HOT_EDGES = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(RULES, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, verdict in RULES:
        found = F.when(rule == name, F.lit(verdict)).otherwise(found)
    return found


def targets_of(html: Column, host: Column) -> Column:
    """Hosts of the page's links to other hosts, one entry per link."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]*)"""), F.lit(1))
    hosts = F.transform(links, lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)))
    return F.filter(hosts, lambda h: (h != "") & (h != host))


def in_pieces(edges: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Edges with their piece, and (host, pieces) of the hosts with more than one."""
    hot = edges.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("pieces")).where("pieces > 1")
    hot = stored(hot, "hot-hosts")
    dealt = edges.join(hot, "src", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("dst"), F.col("pieces")).cast("int"), F.lit(0)))
    return stored(dealt.drop("pieces"), "edges"), hot.withColumnRenamed("src", "host")


def spread(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, most: int = HOT_EDGES) -> DataFrame:
    """(host, score) = seed + DAMPING * sum over edges (src, dst, share) of the score of src."""
    edges, hot = in_pieces(edges, most)
    scores = seeds
    for k in range(1, rounds + 1):
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1))
        sent = scores.join(hot, "host", "left").select(F.col("host").alias("src"), "score", copies.alias("piece"))
        moved = edges.join(sent, ["src", "piece"])
        moved = moved.select(F.col("dst").alias("host"), (DAMPING * F.col("score") * F.col("share")).alias("score"))
        scores = seeds.unionByName(moved).groupBy("host").agg(F.sum("score").alias("score"))
        if k % 5 == 0:
            scores = stored(scores, "scores")
    return scores


def shares(links: DataFrame) -> DataFrame:
    """(host, target, share): each host's links shared out to 1."""
    totals = links.groupBy("host").agg(F.sum("n").alias("total"))
    return links.join(totals, "host").select("host", "target", (F.col("n") / F.col("total")).alias("share"))


def judge_pages(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path")).alias("rule"), targets_of(F.col("html"), F.col("host")).alias("to"))
    rows = stored(rows, "pages")
    ruled = verdict_of(F.col("rule"))
    seeds = stored(
        rows.where("host <> ''").groupBy("host").agg(
            F.avg(F.coalesce((ruled == "allow").cast("double"), F.lit(0.0))).alias("trust"),
            F.avg(F.coalesce((ruled == "block").cast("double"), F.lit(0.0))).alias("distrust"),
        ),
        "seeds",
    )
    links = rows.where("host <> ''").select("host", F.explode("to").alias("target")).groupBy("host", "target").agg(F.count(F.lit(1)).alias("n"))
    links = stored(links, "links")
    shared = stored(shares(links), "shares")
    trust = spread(seeds.select("host", F.col("trust").alias("score")), shared.withColumnsRenamed({"host": "src", "target": "dst"}))
    # A walk goes on from the pages that no rule fits.
    free = seeds.select("host", (1 - F.col("trust") - F.col("distrust")).alias("free"))
    back = shared.join(free, "host").select(F.col("target").alias("src"), F.col("host").alias("dst"), (F.col("share") * F.col("free")).alias("share"))
    distrust = spread(seeds.select("host", F.col("distrust").alias("score")), back)
    scores = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
    scores = stored(scores.na.fill(0.0, ["trust", "distrust"]), "scores")
    judged = rows.drop("to").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    by_links = F.when((F.col("distrust") >= THRESHOLD) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(ruled, by_links).alias("verdict"), "trust", "distrust")
