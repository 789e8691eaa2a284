"""Mixing sources to target weights by a minimum-cost flow.

Documents may belong to several sources. They are aggregated by their set of
sources (the pattern), and a flow network carries tokens from patterns to source
quotas. A pattern's tokens can be used up to ``max_repeats`` times, and each
further repetition costs more than the one before, so tokens are repeated only
where no unused ones can serve. All patterns share the costs, which grow with the
repetition, so every cheapest augmenting path uses the lowest repetition still open:
raising the capacities one repetition at a time and augmenting gives the cheapest
flow.

The driver sees one row per pattern, and refuses more than ``MAX_PATTERNS`` of them
rather than dropping any. Documents stay distributed. A pattern's flow is so many
whole repetitions of all its documents and a rest. The rest goes to the documents
whose seeded hash is lowest. The threshold is found by histograms of 4096 buckets of
the hash, each narrowing the one bucket that holds it, so no group is sorted.

Null texts have size zero. A null source is a source of its own, ordered last. Rows
that repeat id, size and pattern share a hash and are chosen together.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.sources.storage import store

MAX_PATTERNS = 200_000
WEIGHTS = (5.0, 2.0, 1.0)
_LEVEL_BITS, _HASH_BITS = 12, 60
_KEYS = ("_mix_size", "_mix_pattern", "_mix_hash")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], total: float, max_repeats: int) -> list[float]:
    """Shares of ``total`` by weight, none above ``max_repeats`` times its size; excess goes to the others by weight."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        full = [i for i in sorted(open_) if left * weights[i] / weight > max_repeats * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(max_repeats * sizes[i])
            open_.discard(i)
        left -= sum(targets[i] for i in full)
    return targets


def cheapest_flow(capacity: list[int], members: list[list[int]], quotas: list[float],
                  max_repeats: int) -> list[dict[int, float]]:
    """Tokens from each pattern to each of its sources, with as few repetitions as the quotas allow."""
    flow: list[dict[int, float]] = [{s: 0.0 for s in m} for m in members]
    holders: list[list[int]] = [[] for _ in quotas]
    for p, m in enumerate(members):
        for s in m:
            holders[s].append(p)
    used, filled, least = [0.0] * len(capacity), [0.0] * len(quotas), 1e-6
    for repeat in range(1, max_repeats + 1):
        for p in range(len(capacity)):
            while used[p] + least < repeat * capacity[p]:
                # breadth-first from p: pattern -> source, source -> pattern along flow that can be taken back
                came: dict[tuple[str, int], tuple[str, int]] = {}
                queue, seen, end = deque([("p", p)]), {("p", p)}, None
                while queue and end is None:
                    kind, x = queue.popleft()
                    nexts = [("s", s) for s in flow[x]] if kind == "p" else \
                        [("p", q) for q in holders[x] if flow[q][x] > least]
                    for n in nexts:
                        if n not in seen:
                            seen.add(n)
                            came[n] = (kind, x)
                            if n[0] == "s" and filled[n[1]] + least < quotas[n[1]]:
                                end = n
                                break
                            queue.append(n)
                if end is None:
                    break
                path = [end]
                while path[-1] != ("p", p):
                    path.append(came[path[-1]])
                path.reverse()
                amount = min(repeat * capacity[p] - used[p], quotas[end[1]] - filled[end[1]],
                             *(flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "s"))
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                used[p] += amount
                filled[end[1]] += amount
    return flow


@dataclass
class Mix:
    """What the driver decided: per source its size and target, per pattern its tokens and flow by source."""

    sources: dict[str | None, tuple[int, float]]
    capacity: dict[str, int]
    flow: dict[str, dict[str | None, float]]
    decisions: DataFrame


def _keyed(docs: DataFrame, size: Column, sources: Column, id_column: str, seed: int) -> DataFrame:
    pattern = F.to_json(F.array_sort(F.array_distinct(sources)), {"ignoreNullFields": "false"})
    mixed = F.xxhash64(F.lit(seed), F.col(id_column), size, pattern)
    return docs.withColumns({"_mix_size": size, "_mix_pattern": pattern,
                             "_mix_hash": F.shiftrightunsigned(mixed, 64 - _HASH_BITS)})


def _thresholds(sized: DataFrame, wanted: dict[str, float]) -> tuple[dict[str, int], dict[str, float]]:
    """Per pattern the highest hash below which the sizes sum up to no more than is wanted, and what is missing."""
    missing: dict[str, float] = {}
    spark = sized.sparkSession
    done: dict[str, int] = {p: 0 for p, n in wanted.items() if n <= 0}
    opened = {p: (0, 0.0) for p in wanted if p not in done}  # start of the open hash range, tokens before it
    for shift in range(_HASH_BITS - _LEVEL_BITS, -1, -_LEVEL_BITS):
        if not opened:
            break
        state = spark.createDataFrame([(p, start) for p, (start, _) in opened.items()],
                                      "_mix_pattern string, first long")
        inside = sized.join(F.broadcast(state), "_mix_pattern").where(
            (F.col("_mix_hash") >= F.col("first"))
            & (F.shiftright(F.col("_mix_hash") - F.col("first"), shift) < (1 << _LEVEL_BITS)))
        histogram = inside.groupBy("_mix_pattern", F.shiftright("_mix_hash", shift).alias("bucket")).agg(
            F.sum("_mix_size").alias("tokens"), F.min("_mix_hash").alias("low"), F.max("_mix_hash").alias("high"))
        goals = spark.createDataFrame([(p, float(wanted[p] - before)) for p, (_, before) in opened.items()],
                                      "_mix_pattern string, goal double")
        upto = F.sum("tokens").over(_ordered())
        crossing = histogram.withColumn("upto", upto).join(F.broadcast(goals), "_mix_pattern").where(
            (F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("tokens") < F.col("goal")))
        found = {r["_mix_pattern"]: r for r in crossing.collect()}
        following = {}
        for p, (start, before) in opened.items():
            r = found.get(p)
            if r is None:  # all of the pattern is wanted
                done[p] = 1 << _HASH_BITS
            elif r.low == r.high or shift == 0:
                done[p], missing[p] = r.low, wanted[p] - before - (r.upto - r.tokens)
            else:
                following[p] = (r.bucket << shift, before + r.upto - r.tokens)
        opened = following
    return done, missing


def _fillers(sized: DataFrame, below: dict[str, int], missing: dict[str, float]) -> dict[str, int]:
    """Per pattern the hash of the one further document whose size comes nearest to what is missing, if it helps."""
    short = [(p, below[p], float(n)) for p, n in missing.items() if n > 0]
    if not short:
        return {}
    state = sized.sparkSession.createDataFrame(short, "_mix_pattern string, below long, goal double")
    best = sized.join(F.broadcast(state), "_mix_pattern").where("_mix_hash >= below").groupBy(
        "_mix_pattern", "_mix_hash", "goal").agg(F.sum("_mix_size").alias("tokens")).groupBy("_mix_pattern").agg(
        F.min(F.struct(F.abs(F.col("tokens") - F.col("goal")).alias("off"), "_mix_hash", "goal")).alias("best"))
    return {r["_mix_pattern"]: r.best["_mix_hash"] for r in best.collect() if r.best.off < r.best.goal}


def _ordered():
    from pyspark.sql import Window

    return Window.partitionBy("_mix_pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)


def plan_mix(sized: DataFrame, weights: tuple[float, ...] | dict = WEIGHTS, max_repeats: int = 3,
             max_patterns: int = MAX_PATTERNS) -> Mix:
    """Targets, flow and thresholds for rows with the columns of :func:`sized_rows`.

    ``weights`` go to the sources by name, or in turn to the sources in order.
    """
    import json

    rows = sized.groupBy("_mix_pattern").agg(F.sum("_mix_size").alias("tokens")).limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} different sets of sources")
    rows.sort(key=lambda r: r["_mix_pattern"])
    members = [json.loads(r["_mix_pattern"]) for r in rows]
    names = sorted({s for m in members for s in m}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for r, m in zip(rows, members):
        for s in m:
            sizes[number[s]] += r.tokens
    share = [float(weights[s]) if isinstance(weights, dict) else float(weights[i % len(weights)])
             for i, s in enumerate(names)]
    targets = water_fill(sizes, share, sum(r.tokens for r in rows), max_repeats)
    flow = cheapest_flow([r.tokens for r in rows], [[number[s] for s in m] for m in members], targets, max_repeats)
    sent = {r["_mix_pattern"]: sum(f.values()) for r, f in zip(rows, flow)}
    whole, rest = {}, {}
    for r in rows:
        p, n = r["_mix_pattern"], sent[r["_mix_pattern"]]
        whole[p] = min(max_repeats, int((n + 1e-6) // r.tokens)) if r.tokens else 0
        rest[p] = n - whole[p] * r.tokens if whole[p] < max_repeats else 0.0
    below, missing = _thresholds(sized, rest)
    extra = _fillers(sized, below, missing)
    decisions = sized.sparkSession.createDataFrame(
        [(p, whole[p], below[p], extra.get(p, -1)) for p in whole],
        "_mix_pattern string, _mix_whole int, _mix_below long, _mix_extra long")
    return Mix({s: (sizes[i], targets[i]) for s, i in number.items()}, {r["_mix_pattern"]: r.tokens for r in rows},
               {r["_mix_pattern"]: {names[s]: x for s, x in f.items()} for r, f in zip(rows, flow)}, decisions)


def copies_of_keyed() -> Column:
    """Repetitions of a row that holds its keys and its pattern's decision."""
    chosen = (F.col("_mix_hash") < F.col("_mix_below")) | (F.col("_mix_hash") == F.col("_mix_extra"))
    return F.col("_mix_whole") + chosen.cast("int")


def with_copies(docs: DataFrame, mix: Mix, size: Column, sources: Column, id_column: str = "doc_id",
                seed: int = 20) -> DataFrame:
    """The rows with ``copies``, the number of times the mix takes each. No row is shuffled."""
    keyed = _keyed(docs, size, sources, id_column, seed).join(F.broadcast(mix.decisions), "_mix_pattern", "left")
    return keyed.withColumn("copies", copies_of_keyed()).drop(*_KEYS, "_mix_whole", "_mix_below", "_mix_extra")


def sized_rows(docs: DataFrame, size: Column, sources: Column, id_column: str = "doc_id", seed: int = 20) -> DataFrame:
    """What planning needs of each row, stored so that texts are read once."""
    return store(_keyed(docs, size, sources, id_column, seed).select(id_column, *_KEYS), "sizes")


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", id_column: str = "doc_id",
                  weights: tuple[float, ...] | dict = WEIGHTS, max_repeats: int = 3, seed: int = 20) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # names cannot clash inside
    size, member, name = word_count(F.col(f"row.`{text}`")), F.col(f"row.`{source}`"), f"row.`{id_column}`"
    sources = member if docs.schema[source].dataType.typeName() == "array" else F.array(member)
    mix = plan_mix(sized_rows(rows, size, sources, name, seed), weights, max_repeats)
    repeated = with_copies(rows, mix, size, sources, name, seed)
    return repeated.withColumn("copy", F.explode(F.expr("array_repeat(0, copies)"))).select("row.*")
