"""Schemas that drift between files: one consistent table, and a report of every change.

Each line becomes a tagged union: per path the value keeps its own type in a
typed branch, and a canonical form in the type most of that field's values
have. Parallel schemas of many files are fused by counting the alternatives
of each path; partial counts are taken before the shuffle, so a hot file or source
sends a row per task and field.

Definitions: a line is readable if its payload is one JSON object without
repeated keys. A file without readable lines says nothing about its schema
and is passed over. A tie between types goes to the later name in the alphabet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.keys import plain_cve, plain_ip, squeeze
from tidewatch.operators.components import components
from tidewatch.storage import settle

FILE = ["source", "collector_host"]


def type_tag(value: Column) -> Column:
    """string, number, boolean, array or object; null for a JSON null."""
    s = F.schema_of_variant(value)
    return (
        F.when(s == "STRING", "string")
        .when(s.isNull() | (s == "VOID"), F.lit(None).cast("string"))
        .when(s == "BOOLEAN", "boolean")
        .when(s.startswith("ARRAY"), "array")
        .when(s.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def readable(lines: DataFrame) -> DataFrame:
    """The lines whose payload is a JSON object, with it as the variant ``_v``."""
    parsed = lines.withColumn("_v", F.try_parse_json("payload"))
    return parsed.where(F.col("_v").isNotNull() & F.schema_of_variant("_v").startswith("OBJECT"))


def record_key(v: Column) -> Column:
    """What tells a record again in another file: its URL id, address, CVE or session."""
    get = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    named = lambda p, c: F.concat(F.lit(p), F.nullif(c, F.lit("")))
    return F.coalesce(named("u:", squeeze(get("urlhaus_id"))), named("i:", plain_ip(get("ip_address"))), named("c:", plain_cve(get("cve_id"))), named("s:", squeeze(get("session"))))


def branches(lines: DataFrame, *keep: str) -> DataFrame:
    """A row per readable line and top-level field: ``keep``, ``field``, ``value`` (variant), ``tag``, ``pos``; an empty object has one row without field."""
    exploded = lines.select(*keep, "_v").lateralJoin(lines.sparkSession.tvf.variant_explode_outer(F.col("_v").outer()))
    return exploded.select(*keep, F.col("key").alias("field"), "value", type_tag(F.col("value")).alias("tag"), "pos")


def fused(lines: DataFrame, nested: bool = False) -> DataFrame:
    """The fused schema: per file and path every alternative type, ``(file_id, source, collector_host, at, depth, path, tag, n, n_lines)``.

    ``tag`` is null where the value is a JSON null; ``n_lines`` counts the file's lines of which this is the first field, so that their sum is
    the number of its readable lines. Payloads are parsed once, and only counts are moved. With ``nested`` the paths inside objects (``a.b``) and
    arrays (``a[]``) follow, level by level until none is left. A path of null is that of an empty object.
    """
    spark = lines.sparkSession
    level = branches(readable(lines.select("file_id", *FILE, "collected_at", "payload")), "file_id", *FILE, "collected_at").withColumnRenamed("field", "path")
    parts, depth = [], 1
    while True:
        first = F.count_if((F.coalesce("pos", F.lit(0)) == 0) & F.lit(depth == 1)).alias("n_lines")
        about = (*(F.first(c, ignorenulls=True).alias(c) for c in FILE), F.min("collected_at").alias("at"))
        part = settle(level.groupBy("file_id", "path", "tag").agg(F.count(F.lit(1)).alias("n"), first, *about).withColumn("depth", F.lit(depth)), "fused")
        parts.append(part)
        if not nested or part.where("tag in ('array', 'object')").isEmpty():
            return reduce(DataFrame.unionByName, parts)
        deeper = level.where("tag in ('array', 'object')").select("file_id", *FILE, "collected_at", F.col("path").alias("above"), F.col("value").alias("_v"))
        inner = deeper.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
        level = inner.select("file_id", *FILE, "collected_at", F.when(F.col("key").isNull(), F.concat("above", F.lit("[]"))).otherwise(F.concat("above", F.lit("."), "key")).alias("path"), "value", type_tag(F.col("value")).alias("tag"), "pos")
        depth += 1


def alternatives(lines: DataFrame) -> DataFrame:
    """``(source, path, depth, tag, n_values, first_at, first_file)``: each alternative type of each path, nested ones too, and where it appeared first."""
    b = fused(lines, nested=True).where("tag is not null")
    return b.groupBy("source", "path", "depth", "tag").agg(F.sum("n").alias("n_values"), F.min(F.struct("at", "file_id")).alias("_f")).select("source", "path", "depth", "tag", "n_values", F.col("_f.at").alias("first_at"), F.col("_f.file_id").alias("first_file"))


def file_schemas(schema: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the fused schema: files ``(source, collector_host, file_id, seq)`` in order of collection, and their fields ``(..., seq, file_id, field, tag)``.

    A field belongs to a file if more than half of the readable lines have it;
    ``tag`` is that of most of its non-null values, and one without values keeps what it had.
    """
    top = schema.where("depth = 1")
    files = top.groupBy("file_id").agg(*(F.first(c, ignorenulls=True).alias(c) for c in FILE), F.min("at").alias("at"), F.sum("n_lines").alias("n_lines"))
    order = Window.partitionBy(*FILE).orderBy(F.asc_nulls_last("at"), "file_id")  # a row per file
    files = settle(files.withColumn("seq", F.row_number().over(order) - 1), "drift-files")
    per_field = top.where("path is not null").groupBy("file_id", F.col("path").alias("field")).agg(F.sum("n").alias("n"), F.max(F.when(F.col("tag").isNotNull(), F.struct("n", "tag")))["tag"].alias("tag"))
    own = per_field.join(files, "file_id").where(F.col("n") * 2 > F.col("n_lines"))
    before = Window.partitionBy(*FILE, "field").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return files, own.select(*FILE, "seq", "file_id", "field", F.last("tag", ignorenulls=True).over(before).alias("tag"))


def _pairs(files: DataFrame, fields: DataFrame) -> DataFrame:
    """``(pair_file, prev_file, field, old, new, old_tag, new_tag)``: each file's fields beside those of the file before."""
    order = Window.partitionBy(*FILE).orderBy("seq")
    steps = files.select("file_id", F.lag("file_id").over(order).alias("prev_file")).where("prev_file is not null")
    new = fields.join(steps, "file_id").select(F.col("file_id").alias("pair_file"), "prev_file", "field", F.lit(1).alias("role"), "tag")
    old = fields.withColumnRenamed("file_id", "prev_file").join(steps, "prev_file").select(F.col("file_id").alias("pair_file"), "prev_file", "field", F.lit(0).alias("role"), "tag")
    has = lambda r: F.max((F.col("role") == r).cast("int"))
    tag = lambda r: F.max(F.when(F.col("role") == r, F.col("tag")))
    return new.unionByName(old).groupBy("pair_file", "prev_file", "field").agg(has(0).alias("old"), has(1).alias("new"), tag(0).alias("old_tag"), tag(1).alias("new_tag"))


def _value(value: Column, tag: Column) -> Column:
    number = F.try_variant_get(value, "$", "double").cast("string")
    return F.concat(tag, F.lit(":"), F.coalesce(F.when(tag == "number", number), F.to_json(value)))


def renames(lines: DataFrame, gone_or_come: DataFrame) -> DataFrame:
    """``(pair_file, old_field, new_field)``: a field that went while another came, equal in more than half of the shared records.

    ``gone_or_come``: ``(pair_file, prev_file, field, old, new)``. Pairs of
    fields arise only from equal values of the same record, never from all
    combinations. Each field takes part in its best pair at most.
    """
    both = gone_or_come.groupBy("pair_file").agg(F.min("new").alias("a"), F.max("new").alias("b")).where("a = 0 and b = 1").select("pair_file")
    wanted = gone_or_come.join(both, "pair_file", "left_semi").select("pair_file", F.when(F.col("new") == 1, F.col("pair_file")).otherwise(F.col("prev_file")).alias("file_id"), "field", "new")
    v = readable(lines.select("file_id", "payload")).join(wanted.select("file_id").distinct(), "file_id", "left_semi").withColumn("_rec", record_key(F.col("_v"))).where("_rec is not null")
    values = branches(v, "file_id", "_rec").where("tag is not null").join(wanted, ["file_id", "field"]).select("pair_file", "_rec", "field", "new", _value(F.col("value"), F.col("tag")).alias("val")).distinct()
    values = settle(values, "drift-values")
    side = lambda new, name: values.where(F.col("new") == new).select("pair_file", "_rec", F.col("field").alias(name), "val")
    old, new = side(0, "old_field"), side(1, "new_field")
    key = ["pair_file", "old_field", "new_field"]
    equal = old.join(new, ["pair_file", "_rec", "val"]).select(*key, "_rec").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("eq"))
    shared = old.drop("val").distinct().join(equal.select(*key), ["pair_file", "old_field"]).join(new.drop("val").distinct(), ["pair_file", "new_field", "_rec"]).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    like = equal.join(shared, key).where(F.col("eq") * 2 > F.col("n")).withColumn("share", F.col("eq") / F.col("n"))
    by = lambda own, other: F.row_number().over(Window.partitionBy("pair_file", own).orderBy(F.desc("share"), F.desc("eq"), other))
    return like.withColumn("_o", by("old_field", "new_field")).withColumn("_n", by("new_field", "old_field")).where("_o = 1 and _n = 1").select(*key)


def changes(lines: DataFrame) -> DataFrame:
    """``(file_id, change_kind, old_field, new_field)`` of each file against the one before of its source and collector.

    Empty tables give no changes; unreadable and null payloads don't count.
    """
    files, fields = file_schemas(fused(lines))
    p = settle(_pairs(files, fields).where("old <> new or (old_tag <> new_tag)"), "drift-pairs")
    moved = p.where("old <> new")
    ren = settle(renames(lines, moved), "drift-renames")
    gone = moved.where("old = 1").join(ren.select("pair_file", F.col("old_field").alias("field")), ["pair_file", "field"], "left_anti")
    come = moved.where("new = 1").join(ren.select("pair_file", F.col("new_field").alias("field")), ["pair_file", "field"], "left_anti")
    row = lambda df, kind, a, b: df.select(F.col("pair_file").alias("file_id"), F.lit(kind).alias("change_kind"), a.alias("old_field"), b.alias("new_field"))
    f, none = F.col("field"), F.lit("")
    return (
        row(gone, "removed", f, none)
        .unionByName(row(come, "added", none, f))
        .unionByName(row(ren, "renamed", F.col("old_field"), F.col("new_field")))
        .unionByName(row(p.where("old = 1 and new = 1"), "retyped", f, f))
    )


def canonical_names(lines: DataFrame, found: DataFrame) -> DataFrame:
    """``(source, collector_host, original, name)``: the one name that stands for all names linked by renames (the first in the alphabet).

    The links are schema, not data; they are joined into components, however many there are.
    """
    places = lines.groupBy("file_id").agg(*(F.first(c, ignorenulls=True).alias(c) for c in FILE))
    node = lambda c: F.to_json(F.struct(*FILE, F.col(c).alias("field")))
    links = found.where("change_kind = 'renamed'").join(places, "file_id").select(node("old_field").alias("a"), node("new_field").alias("b")).distinct()
    get = lambda c, k: F.get_json_object(c, f"$.{k}")
    return components(links).select(*(get("node", k).alias(k) for k in FILE), get("node", "field").alias("original"), get("component", "field").alias("name"))


def consistent(lines: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """All readable lines in one table, a row per line and field.

    ``field`` is the name that stands for all names a field has had; ``tag``
    says which typed branch (``as_string``, ``as_number``, ``as_boolean``,
    ``as_json``) is filled; ``canonical`` is the value as text in the
    type most of the source's values of the field have, null where it can't be converted.
    ``original`` is the field's name in the file.
    """
    names = canonical_names(lines, changes(lines) if found is None else found).select(*(F.col(c).alias(f"_{c}") for c in FILE), F.col("original").alias("_original"), F.col("name").alias("_name"))
    b = branches(readable(lines), "file_id", "line_no", *FILE).where("field is not null").drop("pos").withColumnRenamed("field", "original")
    same = (F.col("original") == F.col("_original")) & F.col("source").eqNullSafe(F.col("_source")) & F.col("collector_host").eqNullSafe(F.col("_collector_host"))
    named = b.join(names, same, "left").withColumn("field", F.coalesce("_name", "original"))
    main = named.where("tag is not null").groupBy("source", "field", "tag").agg(F.count(F.lit(1)).alias("n")).groupBy("source", "field").agg(F.max(F.struct("n", "tag"))["tag"].alias("main_tag"))
    v, text = F.col("value"), F.try_variant_get("value", "$", "string")
    number = F.coalesce(F.try_variant_get(v, "$", "double"), text.try_cast("double"))
    canonical = (
        F.when(F.col("tag").isNull(), F.lit(None))
        .when(F.col("main_tag") == "number", F.when((number == F.floor(number)) & (F.abs(number) < 1e15), number.cast("long").cast("string")).otherwise(number.cast("string")))
        .when(F.col("main_tag") == "boolean", F.lower(text).try_cast("boolean").cast("string"))
        .when(F.col("main_tag").isin("array", "object"), F.when(F.col("tag") == F.col("main_tag"), F.to_json(v)).when(F.col("main_tag") == "array", F.concat(F.lit("["), F.to_json(v), F.lit("]"))))
        .otherwise(F.when(F.col("tag").isin("array", "object"), F.to_json(v)).otherwise(text))
    )
    only = lambda tag, c: F.when(F.col("tag") == tag, c)
    return named.join(main, ["source", "field"], "left").select(
        "file_id", "line_no", "source", "collector_host", "field", "original", "tag",
        only("string", text).alias("as_string"), only("number", F.try_variant_get(v, "$", "double")).alias("as_number"), only("boolean", F.try_variant_get(v, "$", "boolean")).alias("as_boolean"),
        F.when(F.col("tag").isin("array", "object"), F.to_json(v)).alias("as_json"), canonical.alias("canonical"),
    )
