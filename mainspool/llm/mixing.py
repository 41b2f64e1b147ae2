"""Mix sources to target weights, in words, with repeats where a source is short.

The budget is ``share`` of all words. It is dealt to the sources by weight; a target stops at
``most`` times its source's words, and what that leaves is dealt again to the others until no
target is above (:func:`targets`). In each source the documents stand in the order of a random
key, a digest of seed, id and size. A target of so many whole epochs and a rest takes every
document once an epoch, and once more those in front of the rest; the document on the edge gives
its first words only, so a source's words are its target, rounded down.

Running sums are spread. Equal stretches of the key range hold equal numbers of rows, so a
source is cut into buckets by arithmetic, without sampling, and a hot source has the more of them. Words
are summed inside a bucket, the buckets' totals inside runs of ``FAN`` buckets, and so on; no
window holds a whole source. Rows equal in id, source and size are one row with a count until
the end, so repeats do not crowd a bucket either. Ranks of sources come from a range partitioning.

Null and blank texts have no words and take none. A null source is a source, the last in order; null ids
are ids. Rows equal in id, source and size may be told apart only by what else they hold: as
many of them are taken as of any, in no set order. A source without words has target 0;
an empty table gives no rows. An input column with the name of a new one gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mainspool.llm.common import materialise, without

#: The blanks between words.
BLANKS = "\\x20\\x09-\\x0D"

#: Weights by the source's place in code point order, repeating; budget; the largest target.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0

#: Rows of a bucket, about, and neighbours summed at a time above.
ROWS, FAN = 2048, 1024

#: Sources up to which their table is sent to the tasks, at some 200 bytes each.
SENT = 20_000

#: Copies of one row written by a task at a time.
COPIES = 1 << 16

_SOURCE, _ID, _SIZE = "__source", "__id", "__size"


def words(text: str) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("bigint")


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` written with ``rank`` from 0 in a total order: by partition, then over partitions."""
    dealt = materialise(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    local = dealt.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1)
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # a row per partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    return local.join(F.broadcast(first), "__part").withColumn("rank", F.col("__local") + F.col("__first")).drop("__part", "__local", "__first")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources (__source, source_size, ..)`` with ``weight`` and ``target``, written.

    The level of a unit of weight is found from below: what the full sources leave, over the
    weight of the others, fills further ones until none is above. Each round is one row of sums.
    """
    by = F.col(_SOURCE).asc_nulls_last()
    listed = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _numbered(sources, by).withColumn("weight", F.get(listed, (F.col("rank") % len(weights)).cast("int")))
    ranked = materialise(ranked.withColumn("__most", F.col("source_size") * F.lit(float(most))))
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("__most")
        full, open_, n = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("__most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(above, 1)),
        ).first()
        if n == before or not open_:
            break
        before, level = n, (budget - full) / open_
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("__most"))).drop("__most", "rank")


def _sums_before(rows: DataFrame, by: list[str], place: str, amount: str, level: int = 0) -> DataFrame:
    """``rows`` (one per ``by`` and ``place``) with ``__before``: the amounts at earlier places."""
    here = Window.partitionBy(*by, F.expr(f"{place} div {FAN}")).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("__before", F.coalesce(F.sum(amount).over(here), F.lit(0)))
    if level == 2 or not (rows.agg(F.max(place)).first()[0] or 0) // FAN:
        return local
    above = rows.groupBy(*by, F.expr(f"{place} div {FAN}").alias("__run")).agg(F.sum(amount).alias("__amount"))
    more = _sums_before(above, by, "__run", "__amount", level + 1).select(*(F.col(b).alias(f"{b}_m") for b in by), F.col("__run").alias("__run_m"), F.col("__before").alias("__more"))
    same = [F.col(b).eqNullSafe(F.col(f"{b}_m")) for b in by] + [F.expr(f"{place} div {FAN} = __run_m")]
    joined = local.join(more, same).withColumn("__before", F.col("__before") + F.col("__more"))
    return joined.select(*local.columns)


def plan(docs: DataFrame, seed: int, id: str, source: str, size: Column, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per distinct (``__id``, ``__source``, ``__size``): ``__copies``, the source's ``source_size``
    and ``target``, ``epochs`` taken whole by all, and ``rest_from``, the words of the last epoch in front."""
    rows = docs.select(F.col(f"`{id}`").alias(_ID), F.col(f"`{source}`").alias(_SOURCE), size.alias(_SIZE))
    base = materialise(rows.groupBy(_ID, _SOURCE, _SIZE).agg(F.count("*").alias("__copies")))
    total = F.sum(F.col(_SIZE) * F.col("__copies")).alias("source_size")
    sources = targets(base.groupBy(_SOURCE).agg(total, F.count("*").alias("__rows")), weights, share, most)
    sources = sources.select(F.col(_SOURCE).alias("__of"), "source_size", "__rows", "target")
    sent = F.broadcast(sources) if sources.count() <= SENT else sources
    named = base.join(sent, base[_SOURCE].eqNullSafe(sent["__of"])).drop("__of")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(_ID).cast("string"), F.lit("")), F.col(_SIZE).cast("string")))
    keyed = named.withColumn("__key", key)
    # the first 32 bits of the key, as a part of the key range
    bucket = F.expr(f"cast(conv(substring(__key, 1, 8), 16, 10) AS bigint) * (__rows div {ROWS} + 1) div 4294967296")
    keyed = keyed.withColumn("__bucket", bucket).withColumn("__words", F.col(_SIZE) * F.col("__copies"))
    inside = Window.partitionBy(_SOURCE, "__bucket").orderBy("__key", _ID, _SIZE).rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("__within", F.coalesce(F.sum("__words").over(inside), F.lit(0)))
    totals = materialise(keyed.groupBy(_SOURCE, "__bucket").agg(F.sum("__words").alias("__words")))
    starts = _sums_before(totals, [_SOURCE], "__bucket", "__words").select(F.col(_SOURCE).alias("__of"), F.col("__bucket").alias("__at"), "__before")
    placed = local.join(starts, F.col(_SOURCE).eqNullSafe(F.col("__of")) & (F.col("__bucket") == F.col("__at")))
    budget = F.floor("target")
    return placed.select(
        _ID,
        _SOURCE,
        _SIZE,
        "__copies",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint").alias("epochs"),
        F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).cast("bigint").alias("rest"),
        (F.col("__before") + F.col("__within")).alias("rest_from"),
    )


def _copies(planned: DataFrame) -> DataFrame:
    """A row per copy, ``__copy`` counting from 0; a row of very many copies is dealt out first."""
    if (planned.agg(F.max("__copies")).first()[0] or 1) == 1:
        return planned.withColumn("__copy", F.lit(0).cast("bigint"))
    some = planned.withColumn("__some", F.explode(F.expr(f"sequence(0L, (__copies - 1) div {COPIES})")))
    some = some.repartition(F.xxhash64(_ID, _SOURCE, _SIZE, "__some"))
    each = F.expr(f"sequence(__some * {COPIES}, least(__copies, (__some + 1) * {COPIES}) - 1)")
    return some.withColumn("__copy", F.explode(each)).drop("__some")


#: Words of the last epoch that a copy gives.
_LAST = f"greatest(least(rest - rest_from - __copy * {_SIZE}, {_SIZE}), 0L)"


def mix(docs: DataFrame, seed: int = 1, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: id, source, ``size``, ``source_size``, ``target``, ``taken``, ``epochs`` taken
    whole and ``last_words`` of one more."""
    planned = materialise(plan(docs, seed, id, source, words(text), weights, share, most))
    out = _copies(planned).withColumn("last_words", F.expr(_LAST))
    return out.select(
        F.col(_ID).alias(id),
        F.col(_SOURCE).alias(source),
        F.col(_SIZE).alias("size"),
        "source_size",
        "target",
        (F.col("epochs") * F.col(_SIZE) + F.col("last_words")).alias("taken"),
        "epochs",
        "last_words",
    )


def _nth(rows: DataFrame) -> DataFrame:
    """``rows`` with their number ``__nth`` among those the plan cannot tell apart: by the partition
    they are written from, then over those partitions, so that no window holds all repeats of a row."""
    group = [_ID, _SOURCE, "__z"]
    rows = materialise(rows.withColumn("__part", F.spark_partition_id()))
    counts = rows.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*(F.col(c).alias(f"{c}_f") for c in (*group, "__part")), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    local = rows.withColumn("__local", F.row_number().over(Window.partitionBy(*group, "__part").orderBy(F.lit(1))) - 1)
    same = [F.col(c).eqNullSafe(F.col(f"{c}_f")) for c in (*group, "__part")]
    return local.join(first, same).withColumn("__nth", F.col("__local") + F.col("__first"))


def draw(docs: DataFrame, seed: int = 1, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mixture itself: ``docs`` repeated, with ``epoch`` from 0, a cut text in front of the edge.

    Documents without words are not in it. The whole epochs need no join with the plan, only the
    sources' targets; the last is joined by id, source and size.
    """
    docs = without(docs, ["epoch"])
    planned = materialise(plan(docs, seed, id, source, words(text), weights, share, most))
    sized = docs.withColumn(_SIZE, words(text)).where(F.col(_SIZE) > 0)
    per_source = planned.groupBy(F.col(_SOURCE).alias("__of")).agg(F.max("epochs").alias("__epochs"))
    sent = F.broadcast(per_source) if per_source.count() <= SENT else per_source
    whole = sized.join(sent, F.col(f"`{source}`").eqNullSafe(F.col("__of"))).where("__epochs > 0")
    whole = whole.withColumn("epoch", F.explode(F.expr("sequence(0L, __epochs - 1)")))
    edge = _copies(planned).withColumn("__last", F.expr(_LAST)).where("__last > 0")
    edge = edge.groupBy(_ID, _SOURCE, F.col(_SIZE).alias("__z"), "epochs").agg(F.sum("__last").alias("__left"))
    same = F.col(f"`{id}`").eqNullSafe(F.col(_ID)) & F.col(f"`{source}`").eqNullSafe(F.col(_SOURCE)) & (F.col(_SIZE) == F.col("__z"))
    last = sized.join(edge, same).withColumn("__nth", F.lit(0).cast("bigint"))
    if (planned.agg(F.max("__copies")).first()[0] or 1) > 1:
        last = _nth(last)
    last = last.withColumn("__last", F.expr(f"least(__left - __nth * {_SIZE}, {_SIZE})"))
    last = last.where("__last > 0").withColumn("epoch", F.col("epochs"))
    first = F.expr(f"array_join(slice(regexp_extract_all(`{text}`, '[{BLANKS}]*[^{BLANKS}]+', 0), 1, cast(__last AS int)), '')".replace("\\", "\\\\"))
    cut = last.withColumn(text, F.when(F.col("__last") < F.col(_SIZE), first).otherwise(F.col(f"`{text}`")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return whole.select(*names, "epoch").unionAll(cut.select(*names, "epoch"))


def oracle(seed: int = 1, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> str:
    """The digest of :func:`mix` over ``documents`` in SQL, with one window where Spark has many."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^{BLANKS}]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * {most} AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END AS weight FROM sized GROUP BY source
), filled AS (
  SELECT *, coalesce(sum(most) OVER up, 0) AS full_before, sum(weight) OVER (ORDER BY most / weight DESC, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS weight_left,
    {share} * sum(source_size) OVER () AS budget FROM sources
  WINDOW up AS (ORDER BY most / weight, source DESC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max((budget - full_before) / weight_left) AS level FROM filled WHERE (budget - full_before) / weight_left < most / weight
), aims AS (
  SELECT source, source_size, least(weight * (SELECT coalesce(level, 1e300) FROM level), most) AS target FROM sources
), placed AS (
  SELECT s.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    sum(size) OVER (PARTITION BY s.source ORDER BY md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  budget // source_size * size + greatest(least(budget % source_size - before, size), 0) END AS BIGINT) AS taken FROM placed"""
