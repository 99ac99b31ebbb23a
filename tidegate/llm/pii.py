"""Personal data: candidates from generous patterns, scored by boosted trees, selected by calibrated thresholds.

Base patterns with validators (e-mail, IP address, card, phone) always count. Further generators propose spans that may
overlap them: numbers without a plus sign, card-like numbers, written-out addresses, secrets, national numbers. Each
candidate has a few small format and context features; the training set is the number of candidates and of confirmed
ones for each combination of features, at most one row per combination and fold whatever the corpus. Boosted trees of
depth two are fitted to these counts. For each kind the lowest score at which the wanted precision holds is its
threshold; it is judged out of fold, by trees fitted to the other documents. The trees become one SQL expression.

Confirmation is a validator's word (Luhn sum, octet range, number plan, mixture of letters and digits); validators are
not features, so the trees judge by form and context. All work on rows is DataFrame functions. Patterns are possessive
or bounded, so that long runs of matching characters cost linear time and no stack; places, containment and context are
found by running values and chunks (``scans``), so that very many spans in one text cost little more than their number.

Cases: a null text is empty and has no spans. Repeated documents each keep their row. Offsets count code points, the
end is exclusive. Without candidates nothing is added. A selected candidate stays, also where it
overlaps others, unless a base span or another selected one contains it wholly. Other columns are not used. Texts are
always searched whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.scans import CHUNK, chunks_of, let, part_of, running
from tidegate.session import written

# Base kinds in their order, then the others. In each pattern a match starts where the last one ended or outside a run
# of its own first characters: within a run only the run's start can match, so nothing is tried twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
EXTRA = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:\[at\]|\(at\))\s?[A-Za-z0-9-]{1,63}+"
    r"(?:\s?(?:\[dot\]|\(dot\)|\.)\s?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])"
    r"|(?<![\w:.])(?=:{0,2}+[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){0,6}+)?+::"
    r"(?:[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){0,6}+)?+(?![\w:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?i)(?<![a-z])(?:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s{0,4}+[=:]\s{0,4}+[\"']?[^\s\"']{8,}+",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = ("email", "ip", "card", "phone", "id", "secret")
CONTEXT = r"(?i)(mail|contact|phone|tel|call|fax|mobile|card|visa|account|host|server|address|password|token|key|secret|ssn|login)"
FEATURES = ("kind", "digits", "separated", "mixed", "before", "after", "context", "uniform")

FOLDS = 4
"""Parts of the documents whose candidates are scored by trees fitted to the other parts; copies may be in several."""
ROUNDS = 30
RATE = 0.3
PRECISION = 0.9
"""Share of confirmed candidates that a kind's threshold has to reach."""


def located(text: Column, pattern: str) -> Column:
    """``start, stop, value`` of the leftmost non-overlapping matches, from the matches and the pieces between them."""

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        steps = F.zip_with(gaps, found, lambda gap, value: F.length(gap) + F.length(value))
        return let(steps, lambda own: F.zip_with(stops(own), found, span))

    def stops(own: Column) -> Column:
        return F.zip_with(running(own, F.lit(0), lambda x, y: x + y), own, lambda x, y: x + y)

    def span(stop: Column, value: Column) -> Column:
        return F.struct((stop - F.length(value)).alias("start"), stop.alias("stop"), value.alias("value"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn sum."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, size - place + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _octets(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(p.cast("int") <= 255))


def valid(kind: str, value: Column) -> Column:
    """The base kinds' validators."""
    digits = _digits(value)
    if kind == "ip":
        return _octets(value)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def confirmed(kind: str, value: Column) -> Column:
    """The validators' word on candidates of the further generators."""
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "email":  # labels of a host neither start nor end with a hyphen, the last one is of letters
        return ~value.rlike(r"^\.|\.\.|\.@|@-|-\.[A-Za-z0-9-]+$|\.-") & value.rlike(
            r"(?i)(?:\.|[\[(]dot[\])])\s?[a-z]{2,}$"
        )
    if kind == "phone":
        return digits.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")
    if kind == "id":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "ip":  # where ``::`` stands for groups, at most seven are written
        written_out = F.size(F.filter(F.split(value, ":"), lambda x: x != ""))
        return ~value.contains("::") | (written_out <= 7)
    if kind == "secret":
        secret = F.regexp_replace(value, r"(?i)^[a-z_-]+[\"']?\s*[=:]\s*[\"']?", "")
        return (F.length(secret) >= 12) & secret.rlike("[0-9]") & secret.rlike("[A-Za-z]")
    return F.lit(True)


def _needed(kind: str, extra: bool) -> Column:
    """A cheap condition without which the pattern cannot match."""
    if kind == "email":
        if extra:
            return (F.instr("text", "[at]") > 0) | (F.instr("text", "(at)") > 0)
        return F.instr("text", "@") > 0
    if kind == "secret":
        return (F.instr("text", "=") > 0) | (F.instr("text", ":") > 0)
    if kind == "phone" and not extra:
        return (F.instr("text", "+") > 0) & F.col("digit")
    if kind == "ip" and extra:
        return F.instr("text", ":") > 0
    return F.col("digit")


def _with_sides(spans: str) -> Column:
    """The spans with the up to 24 characters before (``left``) and the one behind them (``right``)."""
    chunks = F.col("chunks")
    chunk = lambda place: F.floor(place / CHUNK).cast("int")

    def add(s: Column) -> Column:
        begin = F.greatest(s["start"] - 24, F.lit(0))
        around = F.concat_ws("", F.get(chunks, chunk(begin)), F.get(chunks, chunk(begin) + 1))
        left = F.substring(around, begin % CHUNK + 1, s["start"] - begin)
        right = F.substring(F.coalesce(F.get(chunks, chunk(s["stop"])), F.lit("")), s["stop"] % CHUNK + 1, F.lit(1))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), left.alias("left"), right.alias("right"))

    return F.transform(spans, add)


def _features(kind: str, s: Column) -> Column:
    value, left, right = s["value"], s["left"], s["right"]
    count = F.length(_digits(value))
    edges = (0, 7, 9, 12, 15, 16, 19)
    bucket = sum((F.when(count > e, 1).otherwise(0) for e in edges), F.lit(0))
    flag = lambda c: F.when(c, 1).otherwise(0)
    side = lambda c, blank, word: F.when(c.rlike(blank), 0).when(c.rlike(word), 2).otherwise(1)
    return F.array(
        F.lit(KINDS.index(kind)),
        bucket,
        flag(value.rlike(r"[\x20().-]")),
        flag(value.rlike("[0-9]") & value.rlike("[A-Za-z]")),
        side(left, r"(?:^|\s)\z", r"[\p{L}\p{N}]\z"),
        side(right, r"^\s?$", r"^[\p{L}\p{N}]$"),
        flag(left.rlike(CONTEXT)),
        flag(_digits(value).rlike(r"^([0-9])\1+$")),
    ).cast("array<int>")


def _passing(kind: str):
    return lambda s: valid(kind, s["value"])


def _base_span(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))


def _candidate(kind: str, check):
    return lambda s: F.struct(
        F.lit(kind).alias("kind"),
        s["start"].alias("start"),
        s["stop"].alias("stop"),
        _features(kind, s).alias("features"),
        check(kind, s["value"]).alias("confirmed"),
    )


def candidates(documents: DataFrame) -> DataFrame:
    """``doc_id, fold``, ``base`` spans and all ``proposed`` spans with features and confirmation, a row per document."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    names = []
    for extra, patterns in ((False, BASE), (True, EXTRA)):
        for kind, pattern in patterns.items():
            names.append((name := f"{kind}_{'more' if extra else 'base'}", kind, extra))
            rows = rows.withColumn(
                name, F.when(_needed(kind, extra), located(F.col("text"), pattern)).otherwise(none)
            )
    base = [F.transform(F.filter(n, _passing(kind)), _base_span(kind)) for n, kind, extra in names if not extra]
    checks = [(n, kind, confirmed if extra or kind == "email" else valid) for n, kind, extra in names]
    proposed = [F.transform(_with_sides(n), _candidate(kind, check)) for n, kind, check in checks]
    some = (F.size(F.concat(*[F.col(n) for n, _, _ in names])) > 0).alias("some")
    rows = rows.select("*", some).withColumn("chunks", F.when(F.col("some"), chunks_of(F.col("text"))))
    return rows.select(
        "doc_id",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(FOLDS)).cast("int").alias("fold"),
        F.when(F.col("some"), F.concat(*base)).otherwise(F.array()).alias("base"),
        F.when(F.col("some"), F.concat(*proposed)).otherwise(F.array()).alias("proposed"),
    )


Tree = tuple  # (feature, value, left, right) or a leaf's number; left holds where the feature is at most the value


def boosted(rows: list[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS, rate: float = RATE) -> list[Tree]:
    """Trees of depth two for the log-odds of confirmation, by Newton steps on counts ``(features, all, confirmed)``."""
    rows = sorted(rows)
    splits = sorted({(f, x[f]) for x, _, _ in rows for f in range(len(x))})
    scores = [0.0] * len(rows)
    trees = []

    def best(members: list[int], slope: list[float], bend: list[float]):
        found = None
        whole = (sum(slope[i] for i in members), sum(bend[i] for i in members))
        for f, v in splits:
            low = [i for i in members if rows[i][0][f] <= v]
            if not low or len(low) == len(members):
                continue
            g, h = sum(slope[i] for i in low), sum(bend[i] for i in low)
            gain = g * g / (h + 1) + (whole[0] - g) ** 2 / (whole[1] - h + 1) - whole[0] ** 2 / (whole[1] + 1)
            if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                found = (gain, f, v, low)
        return found

    def grow(members: list[int], depth: int, slope, bend) -> Tree | float:
        split = best(members, slope, bend) if depth else None
        if split is None:
            value = rate * sum(slope[i] for i in members) / (sum(bend[i] for i in members) + 1)
            for i in members:
                scores[i] += value
            return round(value, 9)
        low = set(split[3])
        return (
            split[1],
            split[2],
            grow([i for i in members if i in low], depth - 1, slope, bend),
            grow([i for i in members if i not in low], depth - 1, slope, bend),
        )

    for _ in range(rounds if rows else 0):
        chance = [1 / (1 + math.exp(-s)) for s in scores]
        slope = [y - n * p for (_, n, y), p in zip(rows, chance, strict=True)]
        bend = [n * p * (1 - p) for (_, n, _), p in zip(rows, chance, strict=True)]
        trees.append(grow(list(range(len(rows))), 2, slope, bend))
    return trees


def value_of(trees: list[Tree], features: tuple[int, ...]) -> float:
    total = 0.0
    for tree in trees:
        while isinstance(tree, tuple):
            tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
        total += tree
    return total


def thresholds(rows, trees: list[Tree], precision: float = PRECISION) -> dict[str, float]:
    """Per kind, the lowest score from which on at least ``precision`` of the candidates are confirmed."""
    return limits_of([(x, n, y, value_of(trees, x)) for x, n, y in rows], precision)


def limits_of(judged, precision: float = PRECISION) -> dict[str, float]:
    """As :func:`thresholds`, of ``features, all, confirmed, score``."""
    out = {}
    for k, kind in enumerate(KINDS):
        own: dict[float, list[int]] = {}
        for x, n, y, score in judged:
            if x[0] == k:
                sums = own.setdefault(round(score, 6), [0, 0])
                sums[0] += n
                sums[1] += y
        n = y = 0
        for score in sorted(own, reverse=True):
            n, y = n + own[score][0], y + own[score][1]
            if y >= precision * n:
                out[kind] = score - 1e-5
    return out


def calibrated(counts, precision: float = PRECISION) -> tuple[list[Tree], dict[str, float]]:
    """Trees for all ``fold, features, all, confirmed``, and thresholds from scores by trees that did not see the fold.

    Where all candidates are of one fold there is nothing apart to judge by; the trees of all of them do.
    """

    def summed(rows) -> list[tuple[tuple[int, ...], int, int]]:
        total: dict[tuple[int, ...], list[int]] = {}
        for _, x, n, y in rows:
            sums = total.setdefault(x, [0, 0])
            sums[0] += n
            sums[1] += y
        return [(x, n, y) for x, (n, y) in total.items()]

    trees = boosted(summed(counts))
    judged = []
    for fold in sorted({c[0] for c in counts}):
        others = boosted(summed([c for c in counts if c[0] != fold])) or trees
        judged += [(x, n, y, value_of(others, x)) for k, x, n, y in counts if k == fold]
    return trees, limits_of(judged, precision)


def _tree_sql(tree, features: str) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    f, v, low, high = tree
    return f"if({features}[{f}] <= {v}, {_tree_sql(low, features)}, {_tree_sql(high, features)})"


def spans(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` spans (kind, start, stop) of every document."""
    found = written(candidates(documents), "spans")
    # At most one row per combination of features in each fold.
    table = (
        found.select("fold", F.explode("proposed").alias("p"))
        .groupBy("fold", F.col("p.features").alias("features"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p.confirmed").cast("long")).alias("y"))
        .collect()
    )
    trees, limits = calibrated([(r.fold, tuple(r.features), r.n, r.y) for r in table], precision)
    score = " + ".join(_tree_sql(t, "p.features") for t in trees) or "0.0D"
    limit = "".join(f" when '{k}' then {v!r}D" for k, v in limits.items())
    chosen = F.expr(
        f"""filter(
            transform(
                proposed,
                p -> named_struct('kind', p.kind, 'start', p.start, 'stop', p.stop, 'score', {score})
            ),
            p -> p.score >= {f"case p.kind{limit} else double('inf') end" if limit else "double('inf')"}
        )"""
    )
    return (
        found.where("size(proposed) > 0")
        .withColumn("chosen", chosen)
        .select("doc_id", "base", outermost("chosen", "base").alias("added"))
        .unionByName(found.where("size(proposed) = 0").select("doc_id", "base", F.col("base").alias("added")))
    )


def outermost(chosen: str, base: str | None = None) -> Column:
    """The spans that no other one, and none of ``base``, contains wholly; of equal ranges the best (score, then kind).

    Sorted by start, longer and better ones first, a span lies within another one if an earlier one reaches its end.
    """
    names = F.lit(sorted(KINDS))

    def ranked(place: int, score):
        return lambda s: F.struct(
            s["start"].alias("start"),
            (-s["stop"]).alias("back"),
            F.lit(place).alias("place"),
            (-score(s)).alias("worse"),
            (-F.array_position(names, s["kind"])).alias("name"),
            s["kind"].alias("kind"),
        )

    every = F.transform(chosen, ranked(1, lambda s: s["score"]))
    if base:
        every = F.concat(F.transform(base, ranked(0, lambda s: F.lit(0.0))), every)

    def alone(order: Column) -> Column:
        ends = F.transform(order, lambda s: -s["back"])
        reached = let(ends, lambda e: running(e, F.lit(-1), F.greatest))
        judged = F.zip_with(order, reached, lambda s, r: F.struct(s.alias("s"), (r < -s["back"]).alias("out")))
        return F.filter(judged, lambda x: x["out"] & (x["s"]["place"] == 1))

    return F.transform(
        let(F.sort_array(every), alone),
        lambda x: F.struct(x["s"]["kind"].alias("kind"), x["s"]["start"].alias("start"), (-x["s"]["back"]).alias("stop")),
    )


def redacted(documents: DataFrame, mark: str = "[{}]", precision: float = PRECISION) -> DataFrame:
    """``doc_id`` and ``text`` with each span replaced by its kind; null texts stay null."""
    whole = documents.select(F.struct(F.col("doc_id").alias("id"), "text").alias("doc_id"), "text")
    found = spans(whole, precision).withColumnRenamed("doc_id", "row")
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"], s["stop"], s["kind"])))
    head, _, tail = mark.partition("{}")

    def marked(order: Column) -> Column:
        return let(F.transform(order, lambda s: s["stop"]), lambda stops: pieces(order, stops))

    def pieces(order: Column, stops: Column) -> Column:
        def piece(s: Column, at: Column) -> Column:
            name = F.concat(F.lit(head), s["kind"], F.lit(tail))
            return F.when(s["start"] >= at, F.concat(part_of(F.col("chunks"), at, s["start"]), name)).otherwise("")

        end = F.coalesce(F.array_max(stops), F.lit(0))
        rest = part_of(F.col("chunks"), end, F.length("row.text"))
        return F.concat(F.array_join(F.zip_with(order, running(stops, F.lit(0), F.greatest), piece), ""), rest)

    done = found.withColumn("chunks", chunks_of(F.coalesce("row.text", F.lit("")))).withColumn("done", let(every, marked))
    return done.select(F.col("row.id").alias("doc_id"), F.when(F.col("row.text").isNotNull(), F.col("done")).alias("text"))


def listed(column: str) -> Column:
    """``kind:start:stop`` by kind as listed, then by start, joined with commas."""
    order = F.array_sort(
        F.transform(
            column,
            lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("k"), s["start"], s["stop"], s["kind"]),
        )
    )
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def report(documents: DataFrame) -> DataFrame:
    """Per document: base spans by kind, a digest of the base spans, and all spans."""
    found = spans(documents)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) as n_{k}") for k in BASE]
    return found.withColumn("every", F.concat("base", "added")).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("every").alias("spans")
    )
