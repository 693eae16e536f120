"""URL filters: host and path rules, and link-graph propagation for what no rule decides; DataFrame operations only.

Hosts with allowed pages are seeds of trust, which flows along the links between hosts; hosts with blocked pages are seeds of distrust,
which flows against them: who links to a blocked host is suspect, who is linked from a trusted one is not. Both are personalised
PageRanks. A host is blocked where the distrust that reaches it over edges exceeds the trust that does by ``margin`` of both together, so that
a verdict does not hang on how many others share the rank; its own seed doesn't count, as the rules have already judged the pages that they
meant.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute and protocol-relative targets of links.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
#: Rules that are written into the plan; a longer list becomes a table that is joined on host suffixes.
MAX_RULES = 200


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as ``struct(length, blocks, rule)``, null if none fits; of equally long ones a block wins, then the greater text."""
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("length"), F.lit(int(verdict == "block")).alias("blocks"), F.lit(h + p).alias("rule")))
        for verdict, h, p in rules
    ]
    return F.greatest(*fits, *fits[:1]) if fits else F.lit(None).cast("struct<length:int,blocks:int,rule:string>")


def with_best_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds ``best`` to ``pages(host, path, ...)``; see ``best_rule``.

    A long list is joined: each different host meets the rules of its suffixes (as many as it has labels), and takes those along as one
    list, so a page meets its host's list once, whatever the number of pages of a host.
    """
    if len(rules) <= MAX_RULES:
        return pages.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    table = pages.sparkSession.createDataFrame([(h, p, int(verdict == "block")) for verdict, h, p in rules], "suffix string, start string, blocks int")
    hosts = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    listed = hosts.withColumn("suffix", F.explode(suffixes)).join(table, "suffix").groupBy("host").agg(F.collect_list(F.struct(F.char_length(F.concat("suffix", "start")).alias("length"), "blocks", F.concat("suffix", "start").alias("rule"), "start")).alias("rules"))
    fits = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["start"])))
    best = F.when(fits.isNotNull(), F.struct(fits["length"].alias("length"), fits["blocks"].alias("blocks"), fits["rule"].alias("rule")))
    return pages.join(listed, "host", "left").withColumn("best", best).drop("rules")


def propagate(seeds: DataFrame, edges: DataFrame, damping: float, tolerance: float = 1e-4, rounds: int | None = None) -> DataFrame:
    """``(host, trust, distrust)``: what reaches each host over edges when both ranks have settled.

    ``seeds(host, allowed, blocked)`` holds shares from 0 to 1, ``edges(src, dst)`` distinct pairs. Both ranks run in one join and one
    partial aggregation a round; a round's result has at most two rows a host. A step shrinks every change by ``damping``, so rounds go on until that
    proves that what is still on the way is under ``tolerance`` of all that was seeded (``rounds`` sets a fixed number instead).
    """
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    into = edges.groupBy("dst").agg(F.count("*").alias("n"))
    forward = edges.join(out, "src").select(F.lit(0).alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), (F.lit(damping) / F.col("n")).alias("part"))
    backward = edges.join(into, "dst").select(F.lit(1).alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), (F.lit(damping) / F.col("n")).alias("part"))
    steps = materialize(forward.unionByName(backward))
    start = materialize(
        seeds.select(F.lit(0).alias("kind"), F.col("host").alias("from"), ((1 - damping) * F.col("allowed")).alias("own"))
        .unionByName(seeds.select(F.lit(1).alias("kind"), F.col("host").alias("from"), ((1 - damping) * F.col("blocked")).alias("own")))
        .where("own > 0")
    )
    # The change of the whole rank from one round to the next shrinks by the damping at least, from what the seeds dealt first.
    needed = rounds if rounds is not None else math.ceil(math.log(tolerance * (1 - damping)) / math.log(damping))
    rank, reached = start.withColumnRenamed("own", "rank"), None
    for k in range(needed):
        reached = steps.join(rank, ["kind", "from"]).groupBy("kind", F.col("to").alias("from")).agg(F.sum(F.col("rank") * F.col("part")).alias("got"))
        last = k == needed - 1
        if k % 3 == 2 or last:
            before, reached = (None if last else rank), materialize(reached)
            rank = reached.join(start, ["kind", "from"], "full").select("kind", "from", (F.coalesce("got", F.lit(0.0)) + F.coalesce("own", F.lit(0.0))).alias("rank"))
            # Most graphs settle sooner: what goes no further than a few hosts needs no more rounds.
            if rounds is None and before is not None:
                moved = rank.join(before.withColumnRenamed("rank", "was"), ["kind", "from"], "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("was", F.lit(0.0)))).alias("moved"), F.sum("rank").alias("all")).first()
                if (moved.moved or 0.0) * damping / (1 - damping) <= tolerance * (moved["all"] or 0.0):
                    break
        else:
            rank = reached.join(start, ["kind", "from"], "full").select("kind", "from", (F.coalesce("got", F.lit(0.0)) + F.coalesce("own", F.lit(0.0))).alias("rank"))
    return reached.groupBy(F.col("from").alias("host")).agg(F.sum(F.when(F.col("kind") == 0, F.col("got")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == 1, F.col("got")).otherwise(0.0)).alias("distrust"))


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", damping: float = 0.85, tolerance: float = 1e-4, margin: float = 0.01) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row.

    ``rules`` are ``(verdict, host, path)``. A null url, or one without ``://``, has an empty host and path: no rule fits, and it is
    allowed. Repeated rows give repeated results; an empty table gives none. A null html has no links. Extra columns are ignored.
    """
    pages = df.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    pages = with_best_rule(pages, rules)
    judged = pages.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.when(F.col("best.blocks") == 1, "block").when(F.col("best.blocks") == 0, "allow").alias("by_rule"))
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda x: F.translate(F.regexp_replace(x, r"^.*@|:\d*$", ""), UPPER, LOWER)))
    edges = materialize(pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").distinct())
    verdict = F.coalesce("by_rule", F.lit("allow"))
    if edges.isEmpty():
        return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    share = lambda v: F.avg(F.coalesce((F.col("by_rule") == v).cast("double"), F.lit(0.0)))
    seeds = judged.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    blocked = propagate(seeds, edges, damping, tolerance).where(F.col("distrust") - F.col("trust") > margin * (F.col("distrust") + F.col("trust"))).select("host", F.lit("block").alias("by_links"))
    return judged.join(blocked, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_links", F.lit("allow")).alias("verdict"))
