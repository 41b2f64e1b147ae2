"""Write decoded records: tab-separated text, ORC or parquet, partitioned or by type,
and register the result as an external table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import Layout
from mainspool.operators.decode import FieldReader, decode_text, struct
from mainspool.operators.route import Catalog, decode_routed
from mainspool.session import exists, java_charsets, limit_generated_methods
from mainspool.sinks.typed import write_types

FORMATS = ("tsv", "orc", "parquet")

# Names and formats of the load-date partition columns.
LOAD_DATE_COLUMNS = {"LOAD_YEAR": "%Y", "LOAD_MONTH": "%m", "LOAD_DAY": "%d"}
LOAD_DATE_DEPTH = {"year": 1, "month": 2, "day": 3}


def partition_values(
    partition: Mapping[str, str] | str | None = None, load_date: str | None = None, on: dt.date | None = None
) -> dict[str, str]:
    """Partition columns with their one value: static pairs first, then the load date.

    ``partition`` is a mapping or ``K=v,K2=v2``. ``load_date`` is ``year``, ``month`` or
    ``day``; ``on`` is the date to use, by default today.
    """
    if isinstance(partition, str):
        partition = dict(p.split("=", 1) for p in partition.split(",") if p)
    values = dict(partition or {})
    if load_date is not None:
        on = on or dt.date.today()
        for name, fmt in list(LOAD_DATE_COLUMNS.items())[: LOAD_DATE_DEPTH[load_date]]:
            values[name] = on.strftime(fmt)
    return values


def to_tsv(df: DataFrame, *, columns: Sequence[str] | None = None, trailing_tab: bool = True) -> DataFrame:
    """One STRING column ``value``: the columns joined by tabs; other columns are dropped."""
    names = list(columns) if columns is not None else df.columns
    return df.select(_line(names, trailing_tab).alias("value"))


def _line(names: Sequence[str], trailing_tab: bool):
    line = F.concat_ws("\t", *(F.col(f"`{n}`").cast("string") for n in names))
    return F.concat(line, F.lit("\t")) if trailing_tab else line


def write(
    df: DataFrame,
    path: str,
    fmt: str = "tsv",
    *,
    partition: Mapping[str, str] | str | None = None,
    load_date: str | None = None,
    on: dt.date | None = None,
    bare_partition: bool = False,
    append: bool | None = None,
    trailing_tab: bool = True,
) -> str:
    """Write a decoded DataFrame; gives back the folder written.

    With partition values the output root may exist and is added to; without, it must
    not exist; ``append`` overrides either. Partition folders are ``K=v``, or the bare
    values with ``bare_partition``. Every task writes its own files: no shuffle.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, not {fmt!r}")
    values = partition_values(partition, load_date, on)
    target, by = path.rstrip("/"), []
    if fmt == "tsv":
        df = to_tsv(df, trailing_tab=trailing_tab)
    if values and bare_partition:
        target = "/".join([target, *values.values()])
    elif values:
        df = df.withColumns({k: F.lit(v) for k, v in values.items()})
        by = list(values)
    append = bool(values) if append is None else append
    out = df.write.mode("append" if append else "errorifexists").partitionBy(*by)
    if fmt == "tsv":
        out.text(target)
    else:
        out.format(fmt).save(target)
    return target


def tsv_by_type(
    routed: DataFrame, catalog: Catalog, *, trailing_tab: bool = True, split: str = "nosplit", dialect: str = "mainframe"
) -> DataFrame:
    """``(rec_type, value)``: every record as a text line in its own type's columns."""
    limit_generated_methods(routed.sparkSession)
    with java_charsets(routed.sparkSession):
        raws, values, lines = [], [], []
        for i, t in enumerate(catalog.types):
            fields, names = t.layout.fields(split), t.layout.columns(split)
            reader, own = FieldReader(t.layout, dialect), f"rec_type = {codec.literal(t.name)}"
            pieces = struct([(n, reader.piece(f)) for f, n in zip(fields, names)])
            texts = struct([(n, reader.as_text(f, f"_{i}.`{n}`")) for f, n in zip(fields, names)])
            raws.append(f"CASE WHEN {own} THEN {pieces} END AS _{i}")
            values.append(f"CASE WHEN {own} THEN {texts} END AS _{i}")
            shown = [codec.marked(f"_{i}.`{n}`") for n in names]
            # an empty last value ends the line in a tab
            ends = ["''"] if trailing_tab else []
            lines.append(f"WHEN {own} THEN concat_ws('\\t', {', '.join(shown + ends)})")
        line = f"CASE {' '.join(lines)} END AS value"
        return routed.selectExpr("rec_type", *raws).selectExpr("rec_type", *values).selectExpr("rec_type", line)


def write_by_type(
    routed: DataFrame,
    catalog: Catalog,
    path: str,
    fmt: str = "tsv",
    *,
    mode: str | None = None,
    keep: Sequence[str] = (),
    on: dt.date | None = None,
    partition: Mapping[str, str] | str | None = None,
    bare_partition: bool = False,
    append: bool | None = None,
    trailing_tab: bool = True,
    split: str = "nosplit",
    dialect: str = "mainframe",
    tasks_per_type: int | None = None,
) -> dict[str, str]:
    """Write one folder per record type, ``<path>/rec_type=<type>``, in one scan; gives back each
    type's folder.

    Text lines have the type's own columns, typed files the kept columns and the type's own, in a
    schema per type (:mod:`mainspool.sinks.typed`). A task writes a
    file for each type it meets; ``tasks_per_type`` instead shuffles the records of each type
    to so many tasks, for inputs of many more tasks than files wanted. Partition folders
    come below the type's, bare values above it.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, not {fmt!r}")
    spark = routed.sparkSession
    path = path.rstrip("/")
    values = partition_values({**catalog.partition, **partition_values(partition)}, catalog.load_date, on)
    append = bool(values) if append is None else append
    if tasks_per_type is not None:
        salt = F.pmod(F.xxhash64("file", "rec_no"), F.lit(tasks_per_type))
        routed = routed.repartition(tasks_per_type * len(catalog.types), "rec_type", salt)
    by = {} if bare_partition else values
    if bare_partition:
        path = "/".join([path, *values.values()])
    if fmt == "tsv":
        rows = tsv_by_type(routed, catalog, trailing_tab=trailing_tab, split=split, dialect=dialect)
        rows = rows.withColumns({k: F.lit(v) for k, v in by.items()})
        rows.write.mode("append" if append else "errorifexists").partitionBy("rec_type", *by).text(path)
    else:
        if not append and exists(spark, path):
            raise FileExistsError(f"{path} already exists")
        kept = [k for k in keep if k != "rec_type"]
        rows = decode_routed(routed, catalog, mode or "typed", keep=kept, split=split, reserved=[*kept, "rec_type", *values])
        write_types(rows, [t.name for t in catalog.types], path, fmt, kept=kept, below="/".join(f"{k}={v}" for k, v in by.items()))
    return {t.name: f"{path}/rec_type={t.name}" for t in catalog.types}


def read_type(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The records of one type that :func:`write_by_type` wrote: the kept columns, the type's own,
    the partition's."""
    return spark.read.format(fmt).load(folder)


def table_name(app: str, table: str | None = None, include: str | None = None) -> str:
    """``app_table``; without a table name, ``app_`` and the include spec without ``. , : =``."""
    suffix = table if table is not None else (include or "").translate(str.maketrans("", "", ".,:="))
    return f"{app}_{suffix}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(
    name: str,
    layout: Layout,
    path: str,
    fmt: str = "tsv",
    *,
    split: str = "nosplit",
    partition: Mapping[str, str] | None = None,
    partition_path: str | None = None,
    columns: Sequence[tuple[str, str]] | None = None,
) -> list[str]:
    """Statements that create an external table over written output and add its partition.

    Text tables have one STRING column per field; ``columns`` gives (name, type) pairs
    for typed tables. ``partition_path`` is the folder of the partition added, by default
    ``K=v`` folders below ``path``.
    """
    listed = list(columns) if columns is not None else [(c, "STRING") for c in layout.columns(split)]
    partition = dict(partition or {})
    body = ", ".join(f"`{c}` {t}" for c, t in [*listed, *((k, "STRING") for k in partition)])
    # a text line holds its tabs and quotes as they are
    using = "csv OPTIONS (sep '\\t', quote '', escape '')" if fmt == "tsv" else fmt
    parts = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in partition)})" if partition else ""
    statements = [f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {using}{parts} LOCATION {_quoted(path)}"]
    if partition:
        values = ", ".join(f"`{k}`={_quoted(v)}" for k, v in partition.items())
        where = partition_path or "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in partition.items())])
        statements.append(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({values}) LOCATION {_quoted(where)}")
    return statements


def register_table(spark: SparkSession, name: str, layout: Layout, path: str, fmt: str = "tsv", **options) -> DataFrame:
    """Run :func:`table_ddl` and give back the table. Nothing is read or written."""
    for statement in table_ddl(name, layout, path, fmt, **options):
        spark.sql(statement)
    return spark.table(name)


def register_type(spark: SparkSession, name: str, folder: str, fmt: str) -> DataFrame:
    """A view of one type's typed output by name."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{folder}`")
    return spark.table(name)


def write_tsv(records: DataFrame, layout: Layout, path: str, **options) -> str:
    """Decode records as text and write tab-separated files."""
    return write(decode_text(records, layout, keep=()), path, "tsv", **options)
