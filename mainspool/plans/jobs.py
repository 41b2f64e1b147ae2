"""The whole jobs: convert record files to tables, and split composite records.

Each is a scan, a few expressions and a write; the functions only put them together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.layout import Layout, LayoutError
from mainspool.operators.decode import decode
from mainspool.operators.route import Catalog, route
from mainspool.operators.rules import raw_filter, select_records, skip_records
from mainspool.operators.segments import split_tagged
from mainspool.sinks.tables import (
    partition_values,
    register_table,
    register_type,
    table_name,
    write,
    write_by_type,
)
from mainspool.sinks.vb import write_vb
from mainspool.sources.fixed import read_fb
from mainspool.sources.variable import current_ranges, read_vb, tagged_vb, vb_ranges, vb_rejects

# Names of the file types.
FILE_TYPES = {"MFVB": ("variable", "mainframe"), "MFFB": ("fixed", "mainframe"), "MFDVB": ("variable", "comma")}

_NO_RECORDS = "file string, rec_no bigint, rec_len int, rec binary"


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    filetype: str = "MFVB",
    *,
    layout: Layout | None = None,
    record_len: int | None = None,
    include: str | None = None,
    exclude: str | None = None,
    record_length: int | None = None,
    strict: bool = False,
    **options,
) -> DataFrame:
    """Records of ``MFVB``, ``MFFB`` or ``MFDVB`` files that the rules keep. A fixed length comes from the
    layout unless given. What the rules can tell from bytes is left out while reading."""
    framing, dialect = FILE_TYPES[filetype.upper()]
    rules = {"include": include, "exclude": exclude, "record_length": record_length, "strict": strict}
    options["where"] = raw_filter(layout, **rules)
    # conditions may need a column that is not wanted
    wanted = options.pop("columns", None)
    if wanted is not None:
        options["columns"] = [c for c in ("file", "rec_no", "rec_len", "rec") if c in {*wanted, "rec_len", "rec"}]
    if framing == "variable":
        records = read_vb(spark, paths, **options)
    else:
        if record_len is None:
            if layout is None:
                raise LayoutError("fixed-length files need a layout or a record length")
            record_len = layout.max_length
        records = read_fb(spark, paths, record_len, **options)
    kept = select_records(records, layout, dialect=dialect, **rules)
    return kept if wanted is None else kept.select(*wanted)


def _fixed_length(catalog: Catalog, record_len: int | None) -> int:
    """The one record length of a catalog's fixed-length files."""
    lengths = {t.layout.max_length for t in catalog.types}
    if record_len is None and len(lengths) != 1:
        raise LayoutError(f"types of lengths {sorted(lengths)} in fixed-length files need record_len")
    return record_len or lengths.pop()


def _table_of(rec_type, app: str | None) -> str:
    """A type's own table where the catalog names one, else one after the type."""
    return rec_type.table or table_name(app or "records", rec_type.name)


def convert(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    *,
    layout: Layout | None = None,
    catalog: Catalog | None = None,
    filetype: str = "MFVB",
    fmt: str = "tsv",
    split: str = "nosplit",
    include: str | None = None,
    exclude: str | None = None,
    record_length: int | None = None,
    strict: bool = False,
    record_len: int | None = None,
    partition: Mapping[str, str] | str | None = None,
    load_date: str | None = None,
    bare_partition: bool = False,
    on: dt.date | None = None,
    app: str | None = None,
    table: str | None = None,
    register: bool = False,
    schema_only: bool = False,
    on_corrupt: str = "fail",
    rejects: str | None = None,
    index: DataFrame | None = None,
    chunk_bytes: int | None = None,
    bdw: bool = False,
) -> dict[str, str]:
    """Decode files and write them; gives back the folder of each table written.

    One ``layout`` gives one table, a ``catalog`` one per record type, whose own rules take
    the place of ``include`` and ``exclude``: giving both is an error. ``register`` creates
    the tables, named after ``app`` and ``table``, the include rules, or the catalog's table or
    record type; ``schema_only`` creates them without reading any input. ``record_len`` is the
    length of fixed-length records, needed where a catalog's types differ in length;
    ``record_length`` keeps only records so long. With ``on_corrupt="reject"`` a corrupt
    file ends where it is corrupt; ``rejects`` is a folder that then lists such places. The
    index of variable-length files is made once for both, unless ``index`` brings one. ``bdw``
    says that their records lie in blocks with descriptors.
    """
    framing, dialect = FILE_TYPES[filetype.upper()]
    if catalog is not None and (include or exclude or strict or table is not None):
        raise ValueError("a catalog has rules and tables of its own: include, exclude, strict and table do not apply")
    if framing == "fixed" and (index is not None or rejects is not None or on_corrupt != "fail"):
        raise ValueError("fixed-length files have no index and no corrupt places")
    mode = "text" if fmt == "tsv" else "flat"
    extra = {"split": split, "dialect": dialect} if mode == "text" else {"split": split}
    empty = spark.createDataFrame([], _NO_RECORDS)
    reading = {} if chunk_bytes is None else {"chunk_bytes": chunk_bytes}
    if framing == "variable":
        reading["bdw"] = bdw
    if catalog is None and layout is None:
        raise LayoutError("convert needs a layout or a catalog")

    where = raw_filter(layout, include=include, exclude=exclude, record_length=record_length, strict=strict)
    unnamed = ("rec_len", "rec")
    named = ("file", *unnamed)  # for errors
    if schema_only:
        records = empty
    elif framing == "fixed":
        length = record_len or layout.max_length if catalog is None else _fixed_length(catalog, record_len)
        records = read_fb(spark, paths, length, columns=unnamed, where=where, **reading)
    else:
        # made, or checked, once for records and rejects
        index = vb_ranges(spark, paths, **reading) if index is None else current_ranges(spark, paths, index, **reading)
        records = read_vb(spark, paths, on_corrupt=on_corrupt, index=index, checked=True, columns=named, where=where, **reading)
        if rejects is not None:
            vb_rejects(spark, paths, index=index, checked=True, **reading).write.parquet(rejects)

    if catalog is not None:
        records = select_records(records, record_length=record_length)
        values = partition_values({**catalog.partition, **partition_values(partition)}, load_date or catalog.load_date, on)
        plain = Catalog(catalog.types)
        root = output.rstrip("/")
        if schema_only:
            folders = {t.name: f"{root}/rec_type={t.name}" for t in catalog.types}
            if fmt != "tsv":
                _empty_types(spark, plain, root, fmt, mode, split)
        else:
            folders = write_by_type(
                route(records, catalog, dialect),
                plain,
                root,
                fmt,
                mode=mode,
                partition=values,
                bare_partition=bare_partition,
                split=split,
                dialect=dialect,
            )
        if register or schema_only:
            for t in catalog.types:
                if fmt == "tsv":
                    below = {} if bare_partition else values
                    register_table(spark, _table_of(t, app), t.layout, folders[t.name], fmt, split=split, partition=below)
                else:
                    register_type(spark, _table_of(t, app), folders[t.name], fmt)
        return folders

    values = partition_values(partition, load_date, on)
    kept = select_records(
        records, layout, include=include, exclude=exclude, record_length=record_length, strict=strict, dialect=dialect
    )
    decoded = decode(kept, layout, mode, keep=(), **extra)
    name = table_name(app or "records", table, include)
    folder = output
    if not schema_only:
        folder = write(decoded, output, fmt, partition=values, bare_partition=bare_partition)
    if register or schema_only:
        columns = None if fmt == "tsv" else [(f.name, f.dataType.simpleString()) for f in decoded.schema.fields]
        where = {"partition_path": folder} if bare_partition and values else {}
        register_table(spark, name, layout, output, fmt, split=split, partition=values, columns=columns, **where)
    return {name: output}


def _empty_types(spark: SparkSession, catalog: Catalog, root: str, fmt: str, mode: str, split: str) -> None:
    """Folders of typed output without rows, so that views of them find their columns."""
    none = spark.createDataFrame([], f"{_NO_RECORDS}, rec_type string, rec_variant string")
    write_by_type(none, catalog, root, fmt, mode=mode, split=split, append=True)


def split(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    *,
    header_layout: Layout,
    header_len: int,
    segment_layout: Layout,
    length_field: str,
    length_offset: int = 0,
    skip_marker: str | None = None,
    skip_field: str | None = None,
    skip_hex: str | None = None,
    filetype: str = "MFVB",
    record_len: int | None = None,
    on_corrupt: str = "fail",
    rejects: str | None = None,
    index: DataFrame | None = None,
    chunk_bytes: int | None = None,
    bdw: bool = False,
) -> None:
    """Write one variable-length record per segment, in one folder per input file.

    ``rejects`` is a folder that lists, from the same scan, the records whose segments end in an
    error or that hold none and, with ``on_corrupt="reject"``, where corrupt files were given up.
    """
    reading = {} if chunk_bytes is None else {"chunk_bytes": chunk_bytes}
    if FILE_TYPES[filetype.upper()][0] == "variable":
        reading["bdw"] = bdw
    if FILE_TYPES[filetype.upper()][0] == "fixed":
        records = scan(spark, paths, filetype, layout=header_layout, record_len=record_len, **reading)
        records = records.withColumn("error", F.lit(None).cast("string"))
    elif on_corrupt == "reject":
        records = tagged_vb(spark, paths, index=index, **reading)
    else:
        records = read_vb(spark, paths, on_corrupt=on_corrupt, index=index, **reading).withColumn("error", F.lit(None).cast("string"))
    if skip_field is not None and skip_hex is not None:
        corrupt = F.col("error").isNotNull()
        records = skip_records(records, header_layout, skip_field, skip_hex, unless=corrupt)
    tagged = split_tagged(
        records, header_len, segment_layout, length_field, length_offset=length_offset, skip_marker=skip_marker
    )
    rejected = write_vb(tagged, output)
    if rejects is not None:
        rejected.write.parquet(rejects)
