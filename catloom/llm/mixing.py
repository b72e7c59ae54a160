"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same set of sources form a pattern. A pattern offers its words once for nothing, a second
time at a cost and a third time at a higher one (convex), each pass up to its whole size; sources ask for their quotas.
The cheapest flow on this small graph says how many words each pattern gives. Whole passes take every document; the last,
partial pass takes documents in the order of a seeded hash up to its number of words, and of the last document only the
words still wanted, so that quotas are met exactly.

The graph has a node for each pattern, whatever the number of documents; the plan is made on the driver and broadcast, a row
for each pattern. There may be ``max_patterns`` of them; more are an error, as no membership is ever changed. Sources that
share no pattern are solved apart, those with a single pattern by a formula. Prefix sums go by hash range and then within a range, never over all rows in one task.

Defined cases: null and empty texts have size 0 and take 0; a null source is a source, sorted last, and so is a
null or empty array of sources; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.llm.common import WORD, free_prefix, stored, text_of

RANGES = 4096


def capped_targets(sizes: list[int], weights: list[float], passes: int = 3, total: int | None = None) -> list[float]:
    """Shares of total (sum(sizes) by default) by weight, at most passes times a source's size, the excess reshared until none is above."""
    open_ = sorted(range(len(sizes)), key=lambda i: (passes * sizes[i] / weights[i], i))
    left, weight, out = sum(sizes) if total is None else total, sum(weights), [0.0] * len(sizes)
    for k, i in enumerate(open_):
        if passes * sizes[i] * weight < left * weights[i]:
            out[i] = float(passes * sizes[i])
            left -= passes * sizes[i]
            weight -= weights[i]
        else:
            for j in open_[k:]:
                out[j] = left * weights[j] / weight
            break
    return out


def _push(to: list[int], cap: list[int], out: list[list[int]], start: int, end: int) -> None:
    """Augment until nothing more goes from start to end: blocking flows over levels."""
    while True:
        level, reached = {start: 0}, [start]
        for a in reached:
            for e in out[a]:
                if cap[e] > 0 and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    reached.append(to[e])
        if end not in level:
            return
        at, path, a = dict.fromkeys(level, 0), [], start
        while True:
            if a == end:
                least = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= least
                    cap[e ^ 1] += least
                full = next(i for i, e in enumerate(path) if not cap[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while at[a] < len(out[a]) and not (cap[out[a][at[a]]] > 0 and level.get(to[out[a][at[a]]]) == level[a] + 1):
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                at[a] += 1
            else:
                break


def _component_flow(supply: list[int], members: list[list[int]], quotas: list[int], n_passes: int) -> list[list[int]]:
    """min_cost_flow of patterns and sources that hang together."""
    n_p, n_s = len(supply), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    to, cap, out = [], [], [[] for _ in range(n_p + n_s + 2)]

    def arc(a: int, b: int, c: int) -> int:
        for x, y, z in ((a, b, c), (b, a, 0)):
            out[x].append(len(to))
            to.append(y)
            cap.append(z)
        return len(to) - 2

    offers = [arc(start, p, 0) for p in range(n_p)]
    arcs = [[arc(p, n_p + s, quotas[s]) for s in own] for p, own in enumerate(members)]
    for s, quota in enumerate(quotas):
        arc(n_p + s, end, quota)
    for _ in range(n_passes):
        for e, size in zip(offers, supply, strict=True):
            cap[e] += size
        _push(to, cap, out, start, end)
    return [[cap[e ^ 1] for e in own] for own in arcs]


def min_cost_flow(supply: list[int], members: list[list[int]], quotas: list[int], pass_costs: tuple[float, ...]) -> list[list[int]]:
    """flow[p][k]: words that pattern p gives to source members[p][k]; as much as can be met, at least cost.

    Costs lie on the passes alone and rise, so shortest paths are those that begin with the cheapest pass that is open: the
    cheapest flow is a largest flow of the first passes, enlarged by the second ones, and so on. Sources that share no pattern
    are apart: a source that has one pattern of its own gets what that gives; others are solved with those they hang together.
    """
    if list(pass_costs) != sorted(pass_costs):
        raise ValueError("passes must not get cheaper")
    parent = list(range(len(quotas)))

    def root(s: int) -> int:
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for own in members:
        for s in own[1:]:
            parent[root(s)] = root(own[0])
    groups: dict[int, list[int]] = {}
    for p, own in enumerate(members):
        groups.setdefault(root(own[0]), []).append(p)
    flow: list[list[int]] = [[] for _ in supply]
    for own in groups.values():
        if len(own) == 1 and len(members[own[0]]) == 1:
            flow[own[0]] = [min(quotas[members[own[0]][0]], len(pass_costs) * supply[own[0]])]
            continue
        names = sorted({s for p in own for s in members[p]})
        at = {s: i for i, s in enumerate(names)}
        for p, f in zip(own, _component_flow([supply[p] for p in own], [[at[s] for s in members[p]] for p in own], [quotas[s] for s in names], len(pass_costs)), strict=True):
            flow[p] = f
    return flow


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def seeded(seed: int, *cols: Column) -> Column:
    """A number below 2**60 that depends on the seed and the columns alone."""
    parts = [F.coalesce(c.cast("string"), F.lit("?")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def _key(pattern: Column) -> Column:
    """A pattern as one string; a null source differs from any name."""
    return F.concat_ws("\x1f", F.transform(pattern, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("~"))))


def _features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sources: str = "source", seed: int = 42) -> dict[str, Column]:
    col = docs[sources]
    is_array = docs.schema[sources].dataType.typeName() == "array"
    one = F.array(F.lit(None).cast("string"))
    pattern = F.when(F.size(col) > 0, F.array_sort(F.array_distinct(col.cast("array<string>")))).otherwise(one) if is_array else F.array(col.cast("string"))
    size = n_words(text_of(docs, text_col))
    return {"pattern": pattern, "size": size, "h": seeded(seed, docs[id_col], size)}


def plan_mix(rows: DataFrame, most: int, *, weights: dict | None = None, passes: int = 3, pass_costs: tuple[float, ...] = (0.0, 1.0, 3.0)) -> DataFrame:
    """rows: pkey, pattern, size, h of each document. For each pattern what it gives, and where its partial pass ends.

    One row per pattern (most of them, more are an error): pkey, whole (full passes), source_size and target of its first source, cut
    (documents whose h is below it are in the partial pass) and share (words taken of each document at the cut).
    """
    spark = rows.sparkSession
    got = rows.groupBy("pkey").agg(F.first("pattern").alias("pattern"), F.sum("size").alias("size")).limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} patterns of sources: join rare sources or raise max_patterns")
    patterns = sorted(((list(r["pattern"]), r["size"]) for r in got), key=lambda x: [(s is None, s or "") for s in x[0]])
    names = sorted({s for own, _ in patterns for s in own}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    members, supply = [[at[s] for s in own] for own, _ in patterns], [size for _, size in patterns]
    sizes = [0] * len(names)
    for own, n in zip(members, supply, strict=True):
        for i in own:
            sizes[i] += n
    weight = [float((weights or {}).get(s, 0 if weights else i % 3 + 1)) for i, s in enumerate(names)]
    if any(w <= 0 for w in weight):
        raise ValueError("every source needs a weight above 0")
    targets = capped_targets(sizes, weight, passes, total=sum(supply))
    flow = min_cost_flow(supply, members, [round(t) for t in targets], pass_costs[:passes])
    plan = [(_text_key(own), size, sum(f) // size if size else 0, sum(f) % size if size else 0, sizes[m[0]], targets[m[0]]) for (own, size), f, m in zip(patterns, flow, members, strict=True)]
    small = spark.createDataFrame(plan, "pkey string, pattern_size long, whole long, rest long, source_size long, target double")
    rows = rows.select("pkey", "size", "h").withColumn("range", F.floor(F.col("h") / (2**60 // RANGES)).cast("int"))
    ranges = rows.groupBy("pkey", "range").agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("range_at", F.sum("words").over(Window.partitionBy("pkey").orderBy("range")) - F.col("words"))
    last = ranges.join(F.broadcast(small), "pkey").where("range_at <= rest and rest < range_at + words").select("pkey", "range", (F.col("rest") - F.col("range_at")).alias("left"))
    inside = rows.join(F.broadcast(last), ["pkey", "range"]).groupBy("pkey", "left", "h").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    inside = inside.withColumn("at", F.sum("words").over(Window.partitionBy("pkey").orderBy("h")) - F.col("words"))
    cuts = inside.where("at <= left and left < at + words").select("pkey", F.col("h").alias("cut"), F.expr("(left - at) div n").alias("share"))
    return small.join(F.broadcast(cuts), "pkey", "left").select("pkey", "whole", "source_size", "target", F.coalesce("cut", F.lit(0)).alias("cut"), F.coalesce("share", F.lit(0)).alias("share"))


def _text_key(own: list) -> str:
    return "\x1f".join("~" if s is None else f"={s}" for s in own)


def _taken() -> Column:
    part = F.when(F.col("h") < F.col("cut"), F.col("size")).when(F.col("h") == F.col("cut"), F.least("share", "size")).otherwise(F.lit(0))
    return (F.col("whole") * F.col("size") + part).cast("long")


_WHERE = ("id_col", "text_col", "sources", "seed")
_MAX_PATTERNS = 100_000


def _split(options: dict) -> tuple[dict, dict, int]:
    """Options of the columns, those of the plan, and max_patterns."""
    plan = {k: v for k, v in options.items() if k not in (*_WHERE, "max_patterns")}
    return {k: v for k, v in options.items() if k in _WHERE}, plan, options.get("max_patterns", _MAX_PATTERNS)


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, pattern (array of sources), size, source_size, target and taken (words, repeats counted) of each row.

    Options: id_col, text_col, sources (a column with a source or an array of them), seed, max_patterns, and those of plan_mix.
    weights: of each source by name; by default 1, 2, 3 repeating in code point order, null last.
    """
    where, own, most = _split(options)
    features = _features(docs, **where)
    rows = stored(docs.select(docs[where.get("id_col", "doc_id")].alias("doc_id"), *[c.alias(n) for n, c in features.items()]), "mix")
    rows = rows.withColumn("pkey", _key(F.col("pattern")))
    return rows.join(F.broadcast(plan_mix(rows, most, **own)), "pkey").select("doc_id", "pattern", "size", "source_size", "target", _taken().alias("taken"))


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    return mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: docs' columns, each row as often as the mix takes it; a partly taken document keeps its first words."""
    (where, own, most), columns, p = _split(options), docs.columns, free_prefix(docs, "_mix_")
    features = _features(docs, **where)
    rows = stored(docs.select(*[c.alias(n) for n, c in features.items()]), "mix")
    plan = plan_mix(rows.withColumn("pkey", _key(F.col("pattern"))), most, **own)
    plan = F.broadcast(plan.select(*[F.col(c).alias(p + c) for c in plan.columns]))
    text_col = where.get("text_col", "text")
    got = docs.select("*", *[c.alias(p + n) for n, c in features.items()], _key(features["pattern"]).alias(f"{p}pkey")).join(plan, f"{p}pkey")
    part = F.when(F.col(f"{p}h") < F.col(f"{p}cut"), F.col(f"{p}size")).when(F.col(f"{p}h") == F.col(f"{p}cut"), F.least(f"{p}share", f"{p}size")).otherwise(F.lit(0))
    text = F.col(text_col)
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, part.cast("int")), "")
    last = F.when(part == F.col(f"{p}size"), text).otherwise(cut)
    times = F.when(F.col(f"{p}size") > 0, F.col(f"{p}whole")).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(False), times), F.when(part > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    got = got.withColumn(f"{p}last", F.explode(copies))
    return got.select(*[F.when(F.col(f"{p}last"), last).otherwise(text).alias(c) if c == text_col else F.col(c) for c in columns])
