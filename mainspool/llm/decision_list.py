"""Quality rules learned as a decision list, from DataFrame and SQL functions only.

Statistics of every whole text are native expressions. Sequential covering grows a rule for
bad documents, a conjunction of thresholds, condition by condition: the thresholds tried lie halfway between
quantiles of the good and of the bad that the rule so far holds for, in the middle, in the tails and among values other than
zero, and are found anew for each condition, so that a rare kind of junk has thresholds of its own once the
common kinds are covered. The counts of good and bad by feature and threshold interval are all that reaches the
driver. The condition of most information gain on two thirds of the documents is taken; the last ones are pruned while that
improves the rule on the other third, and the rule stays if there most of what it covers is bad. What it covers is
removed, and so on until no rule holds up; then single conditions are tried the same way. The rules come out as one ordered
Spark conditional expression.

Null and empty texts have no words. A text is a failure of the base rules, or kept if the first
rule that holds does not reject it. Null labels are not learned from; an id rated both good
and bad counts as bad. Without both good and bad documents there are no rules and all
that pass the base rules stay. Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import materialise, without

#: The contract's white space, symbols, window and base limits.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 3, 50, 50

_BLANK_SQL = "' \\t\\n\\u000b\\u000c\\r'"

#: Quantiles of good and of bad documents between which thresholds lie.
SHARES = (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 0.999)

#: A rule stands by its documents of the pruning third: so much more than this share bad, with one more of either kind assumed.
PRECISION, LEAST_BAD = 0.75, 3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Features by name: SQL over the statistics, safe for texts without words.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
}


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and the counts of every whole text.

    Repeated windows are found by sorting (hash, place) of each text's windows, so the cost is
    n log n in the longest text; a text without repeated hashes skips that.
    """
    t = "__text"
    out = docs.select(F.col(f"`{id}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(t))
    out = out.withColumn("__words", F.expr(f"array_remove(split(translate({t}, {_BLANK_SQL}, '      '), ' '), '')"))
    out = out.withColumn("__lines", F.expr(f"filter(split({t}, '\\n'), l -> length(translate(l, {_BLANK_SQL}, '')) > 0)"))
    out = out.withColumn("n_words", F.size("__words").cast("bigint"))
    windows = f"transform(slice(__words, 1, greatest(int(n_words) - {WINDOW - 1}, 0)), (w, i) -> xxhash64(w, __words[i + 1], __words[i + 2]))"
    out = out.withColumn("__hashes", F.expr(windows))
    out = out.withColumn("__distinct", F.expr("size(array_distinct(__hashes))"))
    pairs = "sort_array(transform(__hashes, (h, i) -> struct(h as h, i as i)))"
    out = out.withColumn("__sorted", F.expr(f"if(__distinct = size(__hashes), null, {pairs})"))
    same_before = "i > 0 and element_at(__sorted, greatest(i, 1)).h = p.h"
    same_after = "i + 1 < size(__sorted) and element_at(__sorted, least(i + 2, size(__sorted))).h = p.h"
    out = out.withColumn("__starts", F.expr(f"sort_array(transform(filter(__sorted, (p, i) -> ({same_before}) or ({same_after})), p -> p.i))"))
    covered = f"aggregate(__starts, struct(0L as n, -{WINDOW} as last), (s, x) -> struct(s.n + least({WINDOW}, x - s.last) as n, x as last), s -> s.n)"
    chars = f"translate({t}, {_BLANK_SQL}, '')"
    return out.select(
        F.col(f"`{id}`"),
        "n_words",
        F.expr(f"cast(length({chars}) as bigint)").alias("word_chars"),
        F.expr(f"cast(length({t}) - length(translate({t}, '{SYMBOLS}', '')) as bigint)").alias("n_symbols"),
        F.expr("cast(size(__lines) - size(array_distinct(__lines)) as bigint)").alias("n_dup_lines"),
        F.expr(f"cast(coalesce({covered}, 0) as bigint)").alias("n_repeat_words"),
        F.expr("cast(size(__lines) as bigint)").alias("n_lines"),
        F.expr(f"cast(length({t}) - length(translate({t}, '{SYMBOLS}!?@~^=+_\\\\\\\\/', '')) as bigint)").alias("n_marks"),
        F.expr(f"cast(length(regexp_replace({t}, '[^\\\\p{{Lu}}]+', '')) as bigint)").alias("n_capitals"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def _thresholds(known: DataFrame) -> dict[str, list[float]]:
    """Halfway between neighbouring quantiles of either side, so that a rule keeps its distance from both."""
    shares = list(SHARES)
    probe = known.groupBy("bad").agg(
        *(F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES),
        *(F.percentile_approx(F.when(F.col(f) != 0, F.col(f)), shares, 10_000).alias(f"{f}_set") for f in FEATURES),
        *(F.array(F.min(f), F.max(f)).alias(f"{f}_ends") for f in FEATURES),
    ).collect()
    out = {}
    for f in FEATURES:
        points = sorted({float(x) for r in probe for c in (f, f"{f}_set", f"{f}_ends") for x in (r[c] or ()) if x is not None})
        out[f] = [(a + b) / 2 for a, b in zip(points, points[1:])]
    return out


def candidates(known: DataFrame) -> list[tuple[float, Condition, int, int]]:
    """Conditions on the growing part by falling information gain: (gain, condition, bad, good); of each
    feature and direction the best."""
    edges = _thresholds(known.where("growing"))
    by_feature = [F.struct(F.lit(i).alias("f"), F.expr(" + ".join(f"int({f} > {e!r}D)" for e in edges[f]) or "0").alias("bin")) for i, f in enumerate(FEATURES)]
    each = known.where("growing").select("bad", F.explode(F.array(*by_feature)).alias("x")).groupBy("x.f", "x.bin")
    counts = each.agg(F.sum(F.col("bad").cast("int")).alias("p"), F.sum((~F.col("bad")).cast("int")).alias("n")).collect()
    out = []
    for i, f in enumerate(FEATURES):
        bins = {r["bin"]: (r["p"], r["n"]) for r in counts if r["f"] == i}
        p0, n0 = (sum(c[k] for c in bins.values()) for k in (0, 1))
        best: dict[bool, tuple[float, Condition, int, int]] = {}
        for k, e in enumerate(edges[f]):
            p, n = (sum(c[j] for b, c in bins.items() if b > k) for j in (0, 1))
            for above, q, m in ((True, p, n), (False, p0 - p, n0 - n)):
                gain = _gain(p0, n0, q, m)
                if gain > 1e-9 and (above not in best or gain > best[above][0]):
                    best[above] = (gain, Condition(f, above, e), q, m)
        out += best.values()
    return sorted(out, key=lambda c: (-c[0], c[1].feature, c[1].above, c[1].threshold))


def _holds(conditions: tuple[Condition, ...]) -> str:
    return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold!r}D" for c in conditions) or "true"


def _stand(known: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """(bad, good) documents of the pruning part that each rule holds for."""
    tried = known.where("not growing")
    sums = [F.sum(F.expr(f"int({_holds(r)} and {'bad' if bad else 'not bad'})")) for r in rules for bad in (True, False)]
    row = tried.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()
    return [(row[2 * i] or 0, row[2 * i + 1] or 0) for i in range(len(rules))]


def _precision(p: int, n: int) -> float:
    return (p + 1) / (p + n + 2)


def _accepted(p: int, n: int) -> bool:
    return p >= LEAST_BAD and _precision(p, n) > PRECISION


def next_rule(known: DataFrame) -> Rule | None:
    """A rule for bad documents among ``known``, grown, pruned and held up; None if there is none."""
    conditions: Rule = ()
    firsts: list[Condition] = []
    while True:
        found = candidates(known.where(_holds(conditions)))
        firsts = firsts or [c for _, c, _, _ in found]
        if not found or found[0][1] in conditions:
            break
        conditions += (found[0][1],)
        if not found[0][3]:  # nothing good left
            break
    if conditions:
        prefixes = [conditions[: k + 1] for k in range(len(conditions))]
        stood = _stand(known, prefixes)
        # the shortest of the best
        best = max(range(len(prefixes)), key=lambda k: (_precision(*stood[k]), -k))
        if _accepted(*stood[best]):
            return prefixes[best]
    if firsts:
        stood = _stand(known, [(c,) for c in firsts])
        held = [(p, c) for (p, n), c in zip(stood, firsts) if _accepted(p, n)]
        if held:
            return (max(held, key=lambda h: h[0])[1],)
    return None


def learn(stats: DataFrame, labels: DataFrame, id: str = "doc_id", quality: str = "quality") -> list[Rule]:
    """Rules that reject documents like those rated 0, from all rated documents."""
    rated = labels.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{quality}`").cast("int").alias("q")).where("q is not null and __id is not null").groupBy("__id").agg(F.min("q").alias("q"))
    one = stats.groupBy(f"`{id}`").agg(*(F.min(c).alias(c) for c in stats.columns if c != id))
    growing = (F.pmod(F.xxhash64("__id", F.lit("grow")), F.lit(3)) < 2).alias("growing")
    known = one.where(~base_failed()).join(rated, one[id] == rated["__id"]).select((F.col("q") <= 0).alias("bad"), growing, *(F.expr(x).cast("double").alias(f) for f, x in FEATURES.items()))
    known = materialise(known)
    rules: list[Rule] = []
    if known.select("bad").distinct().count() < 2:
        return rules
    while rule := next_rule(known):  # each covers rows of the pruning part that are then gone
        rules.append(rule)
        known = known.where(f"not ({_holds(rule)})")
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False for the first rule that holds, else true."""
    out = F
    for rule in rules:
        out = out.when(F.expr(" and ".join(c.sql() for c in rule)), F.lit(False))
    return F.lit(True) if out is F else out.otherwise(F.lit(True))


def apply_rules(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``."""
    stats = materialise(statistics(docs, id, text))
    rules = learn(stats, labels, id, quality)
    failed = base_failed()
    return without(stats, ["base_failed", "kept"]).select(F.col(f"`{id}`"), *BASE, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
