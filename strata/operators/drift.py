"""Schemas that drift between the files of one table: profiles, matching of renamed fields, one unified table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.snapshots import iso_date
from strata.util import cut, sized_join, strip

#: Types in the order in which they are tried; a field without any value has the first.
TYPES = ("integer", "decimal", "date", "text")
#: log2 of the entries of a value sketch; sketches of fewer values are exact.
SKETCH = 12
#: Fields of a file, those with most different values, among which the one that names its records is looked for.
NAMING = 4
#: The least score at which two fields of consecutive files are taken for one field under two names.
RENAME = 0.5


def _csv(line: Column, tab: Column) -> Column:
    """The cells of a delimited line: quoted cells may hold the separator, doubled quotes stand for one."""
    comma = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r'(?s),("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    tabs = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit('(?s)\t("(?:[^"]|"")*"|[^\t]*)'), F.lit(1))
    bare = lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    quoted = F.transform(F.when(tab, tabs).otherwise(comma), bare)
    return F.when(line.contains('"'), quoted).when(tab, F.split(line, "\t")).otherwise(F.split(line, ","))


def _once(names: Column) -> Column:
    """Names of which each stands once; repeated ones are null."""
    return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(F.transform(names, lambda n, i: F.when(F.array_position(names, n) == i + 1, n)))


def _format(path: Column, written: Column) -> Column:
    """csv, tsv, json or geojson: from the path's suffix, else from the format as the ledger has it."""
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))
    text = F.lower(F.coalesce(written, F.lit("")))
    from_text = F.when(text.contains("geo"), "geojson").when(text.contains("json"), "json").when(text.contains("tab") | text.contains("tsv"), "tsv").otherwise("csv")
    return F.when(suffix.isin("csv", "tsv", "json", "geojson"), suffix).otherwise(from_text)


def trimmed(c: Column) -> Column:
    """strip(), without a pattern where all characters are ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.btrim(c, F.lit(" \t\n\x0b\f\r"))).otherwise(strip(c))


def _name(c: Column) -> Column:
    return F.lower(trimmed(F.regexp_replace(c, "^\ufeff", "")))


def files_of(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source_table, local_path, date, format, prev_path): the files of each table in order of date; equal dates by path.

    Files that show no date, neither in their path nor in the ledger, come first.
    """
    held = ledger.where("local_path IS NOT NULL").groupBy("local_path").agg(F.max("snapshot_date").alias("snapshot_date"), F.max("format").alias("format"))
    files = rows.where("source_table IS NOT NULL AND local_path IS NOT NULL").select("source_table", "local_path").distinct().join(held, "local_path", "left")
    files = files.select("source_table", "local_path", F.coalesce(iso_date(F.col("local_path"), F.col("snapshot_date")), F.lit("")).alias("date"), _format(F.col("local_path"), F.col("format")).alias("format"))
    return files.withColumn("prev_path", F.lag("local_path").over(Window.partitionBy("source_table").orderBy("date", "local_path")))


def described(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """files_of() with f and prev, numbers that stand for local_path and prev_path, and head: the header of a .csv or .tsv file. Cut."""
    heads = rows.where("row_no = 0 AND payload IS NOT NULL").groupBy("local_path").agg(F.min("payload").alias("head"))
    delimited = F.col("format").isin("csv", "tsv")
    files = files_of(rows, ledger).join(heads, "local_path", "left").withColumn("head", F.when(delimited, F.col("head")))
    names = _once(F.transform(_csv(F.col("head"), F.col("format") == "tsv"), _name))
    return cut(files.withColumns({"f": F.xxhash64("source_table", "local_path"), "prev": F.when(F.col("prev_path").isNotNull(), F.xxhash64("source_table", "prev_path")), "head_names": names}))


def parse(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(f, row_no, names, values, spare, ...): each data line of described() files with its fields, names in lower case or null.

    Row 0 of a .csv or .tsv file is its header; later lines equal to it are no data. A line with too few cells has nulls at
    the end, spare holds those beyond the header; of a name that occurs twice in a line the first cell counts, the other has no name. A payload that
    isn't an object has no fields. Null payloads yield no row. Further columns of `files` are kept.
    """
    raw = rows.where("payload IS NOT NULL AND source_table IS NOT NULL").select("source_table", "local_path", "row_no", "payload")
    tab, delimited = F.col("format") == "tsv", F.col("format").isin("csv", "tsv")
    lines = sized_join(raw, files, ["source_table", "local_path"], spread=F.col("row_no"))
    lines = lines.where(~delimited | ((F.col("row_no") != 0) & (F.col("payload") != F.col("head"))))
    whole, inner = F.from_json("payload", "map<string,string>"), F.from_json("payload", "struct<properties:map<string,string>>")["properties"]
    lines = lines.withColumn("__map", F.when(F.col("format") == "json", whole).when(F.col("format") == "geojson", inner))
    lines = lines.withColumn("__lower", F.transform(F.map_keys("__map"), lambda n: F.lower(trimmed(n))))
    lines = lines.withColumn("__cells", F.when(delimited, _csv(F.col("payload"), tab)))
    none = F.array().cast("array<string>")
    width = F.size("head_names")
    names = F.when(delimited, F.col("head_names")).when(F.col("__map").isNotNull(), _once(F.col("__lower")))
    filled = F.slice(F.concat("__cells", F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)
    values = F.when(delimited, F.when(F.size("__cells") == width, F.col("__cells")).otherwise(filled)).otherwise(F.map_values("__map"))
    spare = F.when(F.size("__cells") > width, F.slice("__cells", width + 1, F.size("__cells"))).otherwise(none)
    keep = [c for c in files.columns if c not in ("source_table", "local_path", "date", "format", "prev_path", "prev", "head", "head_names", "f")]
    return lines.select("f", "row_no", F.coalesce(names, none).alias("names"), F.coalesce(values, none).alias("values"), spare.alias("spare"), *keep)


def cells_of(parsed: DataFrame) -> DataFrame:
    """(f, row_no, field, value, kind): one row for each cell; blank values are null. kind: 1 integer, 2 decimal, 4 date, 8 text, 0 blank."""
    cells = parsed.select("f", "row_no", "names", F.posexplode("values").alias("i", "v")).select("f", "row_no", F.get("names", F.col("i")).alias("field"), F.nullif(trimmed(F.col("v")), F.lit("")).alias("value"))
    cells = cells.where("field IS NOT NULL")
    return cells.withColumn("kind", kind_of(F.col("value")))


def kind_of(value: Column) -> Column:
    """The bit of the first type that a value fits; 0 for null."""
    integer, decimal, date = r"^[+-]?[0-9]+$", r"^[+-]?[0-9]+(\.[0-9]+)?$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    first = F.ascii(value)  # a digit or a sign, or nothing but text follows
    return F.when(value.isNull(), 0).when(~first.between(48, 57) & ~first.isin(43, 45), 8).when(value.rlike(integer), 1).when(value.rlike(decimal), 2).when(value.rlike(date), 4).otherwise(8)


def type_of(kinds: Column) -> Column:
    """The first of TYPES that all values fit whose kinds are or'ed together."""
    return F.when(kinds <= 1, TYPES[0]).when(kinds <= 3, TYPES[1]).when(kinds == 4, TYPES[2]).when(kinds.isNotNull(), TYPES[3])


def canonical(value: Column, kind: Column) -> Column:
    """The hash of a value without what a change of type does to it: units, bounds, trailing zeros, letter case, the day of a date."""
    year = r"^(?:\d{1,2}[/.]\d{1,2}[/.]|[A-Za-z]{3,9}\.? |(?=\d{4}-\d{2}-\d{2}))(\d{4})"
    bare = r"^(?:[<>~]=?|ca\.?|about)? ?([+-]?\d+(?:\.\d+)?)(?: ?[A-Za-z%/]{1,4})?$"
    told = F.coalesce(F.nullif(F.regexp_extract(value, year, 1), F.lit("")), F.regexp_extract(value, bare, 1))
    number = F.when(kind <= 2, value).when(kind == 4, F.left(value, F.lit(4))).when(value.rlike("[0-9]"), told).try_cast("double")
    return F.when(number.isNotNull(), F.xxhash64(number + F.lit(0.0))).when(value.isNotNull(), F.xxhash64(F.lower(value)))


def profile(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(f, field, kinds, n, filled, sketch): for each field of each of the described() files what its values are like; headers name fields, too. Cut."""
    sketch = F.theta_sketch_agg(canonical(F.col("value"), F.col("kind")), F.lit(SKETCH))
    seen = cells_of(parse(rows, files)).groupBy("f", "field").agg(F.bit_or("kind").alias("kinds"), F.count("*").alias("n"), F.count("value").alias("filled"), sketch.alias("sketch"))
    named = files.select("f", F.explode("head_names").alias("field")).where("field IS NOT NULL")
    none = F.lit(0).cast("long")
    return cut(seen.join(named, ["f", "field"], "full").select("f", "field", F.coalesce("kinds", F.lit(0)).alias("kinds"), F.coalesce("n", none).alias("n"), F.coalesce("filled", none).alias("filled"), "sketch"))


def _likeness(a: str, b: str) -> Column:
    """How alike two sketches are: values in both by values in either, 0 if neither has any."""
    both = F.theta_sketch_estimate(F.theta_union(a, b, F.lit(SKETCH)))
    return F.when(both > 0, F.theta_sketch_estimate(F.theta_intersection(a, b)) / both).otherwise(0.0)


def assign(scores: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of the assignment with the greatest sum: shortest augmenting paths, O(n^3) for n columns of a file."""
    if not scores or not scores[0]:
        return []
    flip = len(scores) > len(scores[0])
    cost = [[-x for x in r] for r in (zip(*scores) if flip else scores)]
    n, m = len(cost), len(cost[0])
    u, v, owner = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], j0, way = i, 0, [0] * (m + 1)
        least, seen = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            seen[j0] = True
            i0, step, j1 = owner[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    now = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if now < least[j]:
                        least[j], way[j] = now, j0
                    if least[j] < step:
                        step, j1 = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0] = owner[way[j0]]
            j0 = way[j0]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return [(b, a) for a, b in pairs] if flip else pairs


def _match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The matched pairs of each file and the file before it, from the scores of all their pairs."""
    for batch in batches:
        out = []
        for file, scores in zip(batch["at"], batch.scores):
            at = {(x["old_field"], x["new_field"]): x["score"] for x in scores}
            olds, news = sorted({o for o, _ in at}), sorted({n for _, n in at})
            pairs = assign([[at.get((o, n), 0.0) for n in news] for o in olds])
            out += [(file, olds[i], news[j]) for i, j in pairs if at.get((olds[i], news[j]), 0.0) >= RENAME]
        yield pd.DataFrame(out, columns=["at", "old_field", "new_field"])


def steps(found: DataFrame, files: DataFrame) -> DataFrame:
    """(at, field, new, old): each field of a file `at` or of the file before it; new and old are its profiles there, null where it has none. Cut."""
    pairs = files.where("prev IS NOT NULL").select(F.col("f").alias("at"), "prev")
    own = F.struct("kinds", "n", "filled")
    new = sized_join(found.withColumn("at", F.col("f")), pairs.select("at"), ["at"]).select("at", "field", F.lit(True).alias("is_new"), own.alias("p"))
    old = sized_join(found.withColumnRenamed("f", "prev"), pairs, ["prev"]).select("at", "field", F.lit(False).alias("is_new"), own.alias("p"))
    side = lambda is_new, c: F.max(F.when(F.col("is_new") == is_new, F.col(f"p.{c}")))
    both = new.unionAll(old).groupBy("at", "field").agg(*[side(s == "new", c).alias(f"{s}_{c}") for s in ("new", "old") for c in ("kinds", "n", "filled")])
    return cut(both)


def renames(rows: DataFrame, files: DataFrame, found: DataFrame, both: DataFrame) -> DataFrame:
    """(at, old_field, new_field): fields of the described() files that go on under another name in file `at`. Cut.

    A field that both files name is itself. The others are matched: scores come from value sketches of the single values
    and of values joined to the record they belong to, from the type and from the likeness of the names; the assignment with
    the greatest sum is taken and pairs below RENAME are left out. The record's name is the value of the field that both
    files share and that tells most records apart, of the NAMING fields of each file with most different values. Only lines
    of files with fields to match are read again.
    """
    loose = both.where("old_n IS NULL OR new_n IS NULL").select("at", "field", F.col("old_n").isNotNull().alias("is_old"), F.coalesce("new_kinds", "old_kinds").alias("kinds"), F.coalesce("new_filled", "old_filled").alias("filled"))
    wanted = loose.groupBy("at").agg(F.collect_set(F.when(F.col("is_old"), F.col("field"))).alias("olds"), F.collect_set(F.when(~F.col("is_old"), F.col("field"))).alias("news")).where("size(olds) > 0 AND size(news) > 0")
    wanted = cut(wanted.join(files.select(F.col("f").alias("at"), "prev"), "at"))
    ends = wanted.select(F.col("at").alias("f")).unionAll(wanted.select(F.col("prev").alias("f"))).distinct()
    sketches = cut(sized_join(found.where("filled > 0").select("f", "field", "sketch", F.col("filled").alias("n")), ends, ["f"]))
    # The record's name: of the fields with most different values, the pair with most values in common that are nearly unique in both.
    many = F.row_number().over(Window.partitionBy("f").orderBy(F.desc("different"), "field"))
    naming = sketches.withColumn("different", F.theta_sketch_estimate("sketch")).withColumn("k", many).where(F.col("k") <= NAMING)
    naming = naming.select("f", "field", "sketch", (F.col("different") / F.col("n")).alias("unique"))
    ends = wanted.select("at", "prev")
    new, old = naming.withColumnRenamed("f", "at"), naming.select(F.col("f").alias("prev"), F.col("field").alias("old_field"), F.col("sketch").alias("old_sketch"), F.col("unique").alias("old_unique"))
    every = ends.join(new, "at").join(old, "prev").withColumn("shared", F.theta_sketch_estimate(F.theta_intersection("sketch", "old_sketch"))).where("shared > 0")
    rank = F.struct(F.col("shared") * (F.col("unique") + F.col("old_unique")), (F.col("field") == F.col("old_field")).alias("same"), "field", "old_field")
    anchor = every.groupBy("at").agg(F.max(rank).alias("a")).select("at", F.col("a.field").alias("new_anchor"), F.col("a.old_field").alias("old_anchor"))
    sides = wanted.join(anchor, "at")
    side = lambda f, is_old, anchor, fields: sides.select(F.col(f).alias("f"), F.struct("at", F.lit(is_old).alias("is_old"), F.col(anchor).alias("anchor"), F.col(fields).alias("wanted")).alias("s"))
    sides = side("at", False, "new_anchor", "news").unionAll(side("prev", True, "old_anchor", "olds")).groupBy("f").agg(F.collect_list("s").alias("sides"))
    lines = parse(rows, files.join(sides, "f")).select("names", "values", F.explode("sides").alias("s"))
    place = lambda n: F.get(F.col("values"), F.array_position("names", n).cast("int") - 1)
    held = lines.select("s.at", "s.is_old", trimmed(place(F.col("s.anchor"))).alias("name"), F.explode(F.transform("s.wanted", lambda w: F.struct(w.alias("field"), F.nullif(trimmed(place(w)), F.lit("")).alias("value")))).alias("c"))
    held = held.select("at", "is_old", "c.field", "name", "c.value").where("name <> '' AND value IS NOT NULL")
    joint = held.groupBy("at", "is_old", "field").agg(F.theta_sketch_agg(F.xxhash64("name", canonical(F.col("value"), kind_of(F.col("value")))), F.lit(SKETCH)).alias("joint"), F.theta_sketch_agg("name", F.lit(SKETCH)).alias("names"))
    # What is known of a loose field, once: its type, its own sketch and those of its records.
    own = sketches.select("f", "field", "sketch")
    known = loose.join(ends, "at").withColumn("f", F.when(F.col("is_old"), F.col("prev")).otherwise(F.col("at"))).join(own, ["f", "field"], "left").join(joint, ["at", "is_old", "field"], "left")
    known = known.groupBy("at").agg(F.collect_list(F.struct("is_old", "field", "kinds", "filled", "sketch", "joint", "names")).alias("k"))
    pairs = known.select("at", F.explode(F.filter("k", lambda x: x["is_old"])).alias("o"), F.filter("k", lambda x: ~x["is_old"]).alias("k")).select("at", "o", F.explode("k").alias("n"))
    records = F.theta_sketch_estimate(F.theta_intersection("n.names", "o.names"))
    agree = F.when(records > 0, F.theta_sketch_estimate(F.theta_intersection("n.joint", "o.joint")) / records)
    values = F.coalesce(_likeness("n.sketch", "o.sketch"), F.lit(0.0))
    name = 1 - F.levenshtein("o.field", "n.field") / F.greatest(F.length("o.field"), F.length("n.field"), F.lit(1))
    empty = (F.col("n.filled") == 0) & (F.col("o.filled") == 0)
    alike = F.when(type_of(F.col("n.kinds")) == type_of(F.col("o.kinds")), 0.05).otherwise(0.0)
    score = F.when(empty, 0.9 * name).otherwise(0.85 * F.coalesce(agree, values) + 0.05 * values + 0.05 * name + alike)
    scored = pairs.select("at", F.col("o.field").alias("old_field"), F.col("n.field").alias("new_field"), F.least(score, F.lit(1.0)).alias("score"))
    scored = scored.groupBy("at").agg(F.collect_list(F.struct("old_field", "new_field", "score")).alias("scores"))
    return cut(scored.mapInPandas(_match, "at long, old_field string, new_field string"))


def changes(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source_table, local_path, old_field, new_field, change_kind): added, removed, renamed and retyped fields.

    Each file is held against the one of the next earlier date of its source_table. A renamed field whose type differs has
    a second row. Rows without source_table or local_path take no part. Extra columns are ignored.
    """
    files = described(rows, ledger)
    found = profile(rows, files)
    both = steps(found, files)
    renamed = renames(rows, files, found, both)
    # A renamed field stands under its new name on both sides, and nowhere else.
    was = renamed.select("at", F.col("new_field").alias("field"), F.col("old_field").alias("was"))
    goes = renamed.select("at", F.col("old_field").alias("field"), F.col("new_field").alias("goes"))
    sides = both.join(was, ["at", "field"], "left").join(goes, ["at", "field"], "left")
    sides = sides.select("at", F.coalesce("goes", "field").alias("new_field"), F.when(F.col("was").isNull() & F.col("old_n").isNotNull(), F.col("field")).alias("old_field"), "old_kinds", F.when(F.col("goes").isNull() & F.col("new_n").isNotNull(), F.col("new_kinds")).alias("new_kinds"))
    one = sides.groupBy("at", "new_field").agg(F.max("old_field").alias("old_field"), F.max(F.when(F.col("old_field").isNotNull(), F.col("old_kinds"))).alias("old_kinds"), F.max("new_kinds").alias("new_kinds"))
    none = F.lit("")
    shown = F.array(
        F.when(F.col("old_kinds").isNull(), F.struct(none.alias("old_field"), F.col("new_field"), F.lit("added").alias("change_kind"))),
        F.when(F.col("new_kinds").isNull(), F.struct(F.col("old_field"), none.alias("new_field"), F.lit("removed").alias("change_kind"))),
        F.when(F.col("new_kinds").isNotNull() & (F.col("old_field") != F.col("new_field")), F.struct("old_field", "new_field", F.lit("renamed").alias("change_kind"))),
        F.when(type_of(F.col("old_kinds")) != type_of(F.col("new_kinds")), F.struct("old_field", "new_field", F.lit("retyped").alias("change_kind"))),
    )
    out = one.select("at", F.explode(F.filter(shown, lambda s: s.isNotNull())).alias("s"))
    return sized_join(out, files.select(F.col("f").alias("at"), "source_table", "local_path"), ["at"]).select("source_table", "local_path", "s.old_field", "s.new_field", "s.change_kind")


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walks each table's files from the last to the first and names every field as the last file that has it does."""
    table, names, now, following = None, {}, None, {}
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.source_table != table:
                table, names, now, following = row.source_table, {}, None, {}
            if row.f != now:
                now, names, following = row.f, following, {}
            name = names.get(row.field, row.field)
            out.append((row.source_table, row.f, row.field, name, row.kinds))
            following[row.old_field if isinstance(row.old_field, str) else row.field] = name
        yield pd.DataFrame(out, columns=["source_table", "f", "field", "name", "kinds"])


def unify(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source_table, local_path, row_no, fields): every data line with its fields under the names and types of its whole table.

    fields maps each of the line's fields, called as the last file that has it calls it, to its value as text (null if
    blank). A field that left and came back is one field. All values of a field of a table are written as the one type that
    they all fit: integers without signs or zeros before them, decimals as doubles are written, dates, or text as it is. Cells
    beyond a line's header are fields named spare_1 and so on. Of two fields of a line that go by one name the first counts.

    Names are resolved in a streaming walk over the fields of each table's files, which holds those of two files at a time;
    lines are renamed where they stand, by a list of the fields of each file.
    """
    files = described(rows, ledger)
    found = profile(rows, files)
    renamed = renames(rows, files, found, steps(found, files)).withColumnRenamed("at", "f").withColumnRenamed("new_field", "field")
    fields = found.select("f", "field", "kinds").join(renamed, ["f", "field"], "left").join(files.select("f", "source_table", "date", "local_path"), "f")
    fields = fields.repartition("source_table").sortWithinPartitions("source_table", F.desc("date"), F.desc("local_path"), "field")
    named = cut(fields.select("source_table", "f", "field", "old_field", "kinds").mapInPandas(_chain, "source_table string, f long, field string, name string, kinds int"))
    types = named.groupBy("source_table", "name").agg(type_of(F.bit_or("kinds")).alias("type"))
    lookup = named.join(types, ["source_table", "name"]).groupBy("f").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("name", "type").alias("to")))).alias("__to"))
    lines = parse(rows, files.withColumn("at", F.struct("source_table", "local_path")).join(lookup, "f", "left"))

    def written(value: Column, kind: Column) -> Column:
        return F.when(kind == TYPES[0], value.try_cast("decimal(38,0)").cast("string")).when(kind == TYPES[1], value.try_cast("double").cast("string"))

    def entry(c: Column) -> Column:
        to, value = F.try_element_at("__to", c["names"]), F.nullif(trimmed(c["values"]), F.lit(""))
        return F.struct(F.coalesce(to["name"], c["names"]).alias("k"), F.coalesce(written(value, to["type"]), value).alias("v"))

    own = F.transform(F.filter(F.arrays_zip("names", "values"), lambda c: c["names"].isNotNull()), entry)
    spare = F.transform("spare", lambda v, i: F.struct(F.concat(F.lit("spare_"), (i + 1).cast("string")).alias("k"), F.nullif(trimmed(v), F.lit("")).alias("v")))
    lines = lines.withColumn("__c", F.concat(own, spare)).withColumn("__k", F.transform("__c", lambda x: x["k"]))
    first = F.array_sort(F.filter("__c", lambda c, i: F.array_position("__k", c["k"]) == i + 1))
    return lines.select("at.source_table", "at.local_path", "row_no", F.map_from_entries(first).alias("fields"))
