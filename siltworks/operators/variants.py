"""JSON of any shape, one level of nesting a round: leaves with their paths, and fingerprints that ignore signed-URL churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.sources.state import forget, kept


def step(key: Column, position: Column) -> Column:
    """One step of a path: ``.key``, ``."odd key"`` or ``[0]``."""
    quoted = F.concat(F.lit('."'), F.regexp_replace(key, r'(["\\])', r"\\$1"), F.lit('"'))
    named = F.when(key.rlike(r"\A[A-Za-z_][A-Za-z0-9_]*\z"), F.concat(F.lit("."), key)).otherwise(quoted)
    return F.when(key.isNotNull(), named).otherwise(F.concat(F.lit("["), position.cast("string"), F.lit("]")))


def json_leaves(df: DataFrame, key: str, text: str, volatile: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, path, value, in_file, name): every scalar, empty object and empty array of a JSON column.

    ``value`` is its JSON; ``name`` the object key it stands at. ``in_file`` is true
    for the members of an object that stands under the key ``file`` of an object of
    type ``file``; of these members, those named in ``volatile`` are left out with all
    they hold. Each round opens one level, so the rounds are as many as the deepest
    text has levels, and rows of any shapes share a column. A text that is no JSON,
    or repeats a key, has one row with path and value null; a null text none.
    """
    parsed = df.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.try_parse_json(text).alias("node"))
    level = parsed.select("id", F.when(F.col("node").isNotNull(), "$").alias("path"), "node", F.lit(False).alias("in_file"), F.lit(None).cast("string").alias("name"), F.lit(False).alias("is_file"))
    leaves, written = None, []
    while True:
        members, left_out = F.expr("try_variant_get(node, '$', 'map<string,variant>')"), F.array(*(F.lit(v) for v in volatile)).cast("array<string>")
        stable = F.when(F.col("is_file"), F.map_filter("members", lambda k, _: ~F.array_contains(left_out, k))).otherwise(F.col("members"))
        opened = level.withColumn("members", members).withColumn("kind", F.expr("try_variant_get(element_at(members, 'type'), '$', 'string')"))
        opened = opened.withColumn("members", stable).withColumn("items", F.expr("try_variant_get(node, '$', 'array<variant>')"))
        held = kept(opened.withColumn("many", F.coalesce(F.size("members"), F.size("items"), F.lit(0))), "json-level")
        written.append(held)
        value = F.when(F.size("members") == 0, "{}").otherwise(F.to_json("node"))
        done = held.where("many <= 0").select("id", "path", value.alias("value"), "in_file", "name")
        leaves = done if leaves is None else leaves.unionByName(done)
        wide = held.where("many > 0")
        if wide.isEmpty():
            break
        inside = wide.where("members is not null").select("id", "path", "kind", F.col("is_file").alias("in_file"), F.explode(F.map_entries("members")).alias("e"))
        under_file = F.coalesce((F.col("e.key") == "file") & (F.col("kind") == "file"), F.lit(False))
        named = inside.select("id", F.concat("path", step(F.col("e.key"), F.lit(None))).alias("path"), F.col("e.value").alias("node"), "in_file", F.col("e.key").alias("name"), under_file.alias("is_file"))
        listed = wide.where("items is not null").select("id", "path", F.posexplode("items").alias("at", "node"))
        place = F.concat("path", step(F.lit(None).cast("string"), F.col("at")))
        level = named.unionByName(listed.select("id", place.alias("path"), "node", F.lit(False).alias("in_file"), F.lit(None).cast("string").alias("name"), F.lit(False).alias("is_file")))
    out = kept(leaves, "json-leaves").withColumnRenamed("id", key)
    for held in written:
        forget(held)
    return out


def metadata_fingerprints(df: DataFrame, key: str, text: str, top: tuple[str, ...] = ("properties", "cover", "icon")) -> DataFrame:
    """Rows (key, fingerprint, leaves): what the members ``top`` of a JSON text hold, whatever their shapes.

    Signed files do not count as changed: in an object of type ``file``, at any depth,
    ``file.expiry_time`` is left out and ``file.url`` loses its query and fragment.
    A text that is no JSON has a null fingerprint.
    """
    named = F.regexp_extract("path", r'\A\$(?:\.([A-Za-z_][A-Za-z0-9_]*)|\."((?:[^"\\]|\\.)*)")', 1)
    counted = json_leaves(df, key, text, ("expiry_time",)).where(F.col("path").isNull() | (F.col("path") == "$") | named.isin(*top))
    bare = F.when(F.col("in_file") & (F.col("name") == "url") & F.startswith("value", F.lit('"')), F.regexp_replace("value", r'[?#].*"\z', '"')).otherwise(F.col("value"))
    line = F.concat("path", F.lit("="), bare)
    # the lines of one text
    whole = counted.groupBy(key).agg(F.sort_array(F.collect_list(line)).alias("lines"), F.count_if(F.col("path").isNull()).alias("bad"))
    digest = F.when(F.col("bad") == 0, F.sha2(F.array_join("lines", "\n"), 256))
    return whole.select(key, digest.alias("fingerprint"), F.size("lines").cast("long").alias("leaves"))
