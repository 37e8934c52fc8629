"""Entries to positions: the layout table, for many copybooks at once.

How it works, natively and with one shuffle of the lines:

1. the entries of a copybook, as many as its record description has, are gathered into one array;
2. one pass over the array in line order keeps the open groups and finds for every entry its ancestors, the
   position of its first occurrence, and the groups whose occurrences move it. Storage sizes are differences of
   one running sum, so nothing is summed twice. What redefines another entry takes over that entry's first
   position and its movers, as far as they enclose both: nested redefinitions need no further step, as a target
   always stands above;
3. every entry is repeated once per combination of the occurrence numbers of its ancestors and itself, and the
   position of each is ``first + sum(index * size)`` over the groups that move it: a row expression. ``occ_path`` =
   [line, index, line, index, ...] sorts in storage order.

Names that occur twice in a record are numbered by another row expression: an entry knows the earlier entries that
can take the same name, and which of their occurrences do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fixedrecon.operators.copybook import (
    UNKNOWN_COPYBOOK,
    describe_entries,
    is_storage,
    statements,
)

LAYOUT_COLUMNS = [
    "copybook_id", "copybook_name", "record_no", "record_name", "line_no", "occ_path", "level",
    "field_name", "base_name", "kind", "pic_clause", "data_type", "decimal_positions", "length",
    "start_pos", "end_pos", "occurs", "occurrence", "redefines", "in_redefinition", "parent",
]
LARGEST = 2**31 - 1  # the last position of a record
RUN = 4096  # occurrences made at a time
NUMBERED = r"((?:_\d{2,})*)$"  # what occurrence numbers look like at the end of a name
NO_REGION = -1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. As the start of an empty fold: a transform would copy what ``use`` returns."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def gather_books(lines: DataFrame) -> DataFrame:
    """One row per copybook: ``entries`` in line order, ``rejects``, ``repeated`` (repeated entries, as they are
    reported where the copybook does not fit) and ``copybook_name``, the first 01 entry."""
    described = (
        describe_entries(statements(lines))
        .withColumn("depth", F.when(F.col("level") == 77, 1).otherwise(F.col("level")))
        .withColumn("is_group", F.col("pic_clause") == "")
        .withColumn("numbered", F.when(F.substring("field_name", -1, 1).between("0", "9"), F.regexp_extract("field_name", NUMBERED, 1)).otherwise(""))
        .withColumn("stem", F.left("field_name", F.length("field_name") - F.length("numbered")))
        .withColumn(
            "numbers",
            F.when(F.col("numbered") != "", F.regexp_extract_all("numbered", F.lit(r"_(\d+)"), F.lit(1))).otherwise(F.array().cast("array<string>")),
        )
        .drop("numbered")
    )
    entry = F.struct(
        "line_no", "level", "depth", "is_group", "field_name", "stem", "numbers", "pic_clause", "data_type",
        "decimal_positions", "length", "occurs", "redefines",
    )

    def listed(condition: Column, row: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, row)))

    oversized = F.struct("line_no", "statement", F.lit("expansion does not fit").alias("reject_reason"))
    return (
        described.groupBy("copybook_id")
        .agg(
            listed(is_storage(), entry).alias("entries"),
            listed(F.col("reject_reason").isNotNull(), F.struct("line_no", "statement", "reject_reason")).alias("rejects"),
            listed(is_storage() & (F.col("occurs") > 1), oversized).alias("repeated"),
            F.min(F.when(F.col("level") == 1, F.struct("line_no", "field_name"))).alias("first_01"),
        )
        .withColumn("copybook_name", F.coalesce("first_01.field_name", F.lit(UNKNOWN_COPYBOOK)))
        .drop("first_01")
    )


# What the pass keeps of an open entry. ``times``: occurrences of the entry in its record; ``total``: widths times
# occurrences of what its region holds below it so far; ``before``: that of the whole region when the entry came.
_OPEN = (
    "struct<i:int,depth:int,is_group:boolean,name:string,times:double,repeats:array<int>,region:int,"
    "before:double,first:double,movers:array<int>,total:double>"
)
_PLACED = (
    "struct<record_no:int,record_name:string,parent:string,chain:array<int>,repeats:array<int>,region:int,"
    "first:double,movers:array<int>,times:double>"
)


def _step(state: Column, entry: Column) -> Column:
    """The pass of ``place_entries`` goes on by one entry, the ``i``-th."""
    i, starts = F.size(state["placed"]), entry["depth"] == 1
    nothing = F.array().cast(f"array<{_OPEN}>")
    opened = F.struct(
        F.when(starts, nothing).otherwise(F.filter(state["open"], lambda o: o["depth"] < entry["depth"])).alias("open"),
        F.when(starts, state["open"]).otherwise(F.filter(state["open"], lambda o: o["depth"] >= entry["depth"])).alias("closed"),
        F.when(starts, i).otherwise(state["since"]).alias("since"),
        F.when(starts, F.lit(0.0)).otherwise(state["total"]).alias("total"),
        F.when(starts, state["record_no"] + 1).otherwise(state["record_no"]).alias("record_no"),
        F.when(starts, entry["field_name"]).otherwise(state["record_name"]).alias("record_name"),
    )

    def enclosed(now: Column, groups: Column) -> Column:
        names = F.transform(F.slice("entries", now["since"] + 1, i - now["since"]), lambda e: e["field_name"])
        named = F.when(entry["redefines"].isNotNull(), F.array_position(names, entry["redefines"]).cast("int"))
        return F.struct(
            groups.alias("groups"),
            F.get(groups, F.size(groups) - 1).alias("parent"),
            F.get(state["placed"], F.when(named > 0, now["since"] + named - 1)).alias("target"),
        )

    def placed(now: Column, around: Column) -> Column:
        parent, target = around["parent"], around["target"]
        region = F.when(target.isNotNull(), i).otherwise(F.coalesce(parent["region"], F.lit(NO_REGION)))
        above = F.coalesce(parent["repeats"], F.array().cast("array<int>"))
        shared = F.filter(target["movers"], lambda m: F.exists(around["groups"], lambda g: g["i"] == m))
        return F.struct(
            region.alias("region"),
            (F.coalesce(parent["times"], F.lit(1.0)) * entry["occurs"]).alias("times"),
            F.when(entry["occurs"] > 1, F.array_append(above, entry["occurs"])).otherwise(above).alias("repeats"),
            F.when(target.isNotNull(), F.lit(0.0))
            .when(region == NO_REGION, now["total"])
            .otherwise(F.get(F.filter(now["open"], lambda o: o["i"] == region), F.lit(0))["total"])
            .alias("before"),
            F.array_append(
                F.when(target.isNotNull(), shared).otherwise(F.coalesce(parent["movers"], F.array().cast("array<int>"))), i
            ).alias("movers"),
        )

    def finished(now: Column, around: Column, at: Column) -> Column:
        parent, target = around["parent"], around["target"]
        first = (
            F.when(target.isNotNull(), target["first"])
            .when(parent.isNull(), at["before"])
            .otherwise(parent["first"] + (at["before"] - parent["before"]) / parent["times"])
        )
        width = F.when(entry["is_group"], F.lit(0.0)).otherwise(entry["length"] * at["times"])
        grown = F.transform(
            now["open"], lambda o: o.withField("total", o["total"] + F.when(o["region"] == at["region"], width).otherwise(0.0))
        )
        new = F.struct(
            i, entry["depth"], entry["is_group"], entry["field_name"], at["times"], at["repeats"], at["region"],
            at["before"], first, at["movers"], F.lit(0.0),
        ).cast(_OPEN)
        row = F.struct(
            now["record_no"], now["record_name"], parent["name"],
            F.array_append(F.transform(around["groups"], lambda g: g["i"]), i),
            at["repeats"], at["region"], first, at["movers"], at["times"],
        ).cast(_PLACED)
        return F.struct(
            F.array_append(grown, new).alias("open"),
            now["since"].alias("since"),
            (now["total"] + F.when(at["region"] == NO_REGION, width).otherwise(0.0)).alias("total"),
            now["record_no"].alias("record_no"),
            now["record_name"].alias("record_name"),
            F.array_append(state["placed"], row).alias("placed"),
            F.when(F.size(now["closed"]) > 0, F.concat(state["sizes"], F.transform(now["closed"], _size)))
            .otherwise(state["sizes"])
            .alias("sizes"),
        )

    return _let(
        opened,
        lambda now: _let(
            F.filter(now["open"], lambda o: o["is_group"]),
            lambda groups: _let(
                enclosed(now, groups), lambda around: _let(placed(now, around), lambda at: finished(now, around, at))
            ),
        ),
    )


def _size(entry: Column) -> Column:
    """Positions taken by one occurrence of a group that is complete."""
    return F.struct(entry["i"].alias("i"), (entry["total"] / entry["times"]).alias("storage"))


def place_entries(books: DataFrame) -> DataFrame:
    """Add ``placed``, for each entry: record, ancestors (``chain``, by place in the array, with the entry itself), the
    0-based position of its ``first`` occurrence, its ``movers``, the redefining ``region`` it lies in; ``sizes``: the
    storage of each entry that is a group; ``fits``: whether all occurrences end at a position that an integer holds.

    Each 01 and each stand-alone 77 starts a record. A group encloses what follows on deeper levels until a level
    as high as its own comes. A name is redefined by its first entry in the record, if that stands above. Sums are
    doubles: exact for every copybook that fits, and without overflow for the others."""
    zero = F.struct(
        F.array().cast(f"array<{_OPEN}>").alias("open"),
        F.lit(0).alias("since"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("record_no"),
        F.lit(None).cast("string").alias("record_name"),
        F.array().cast(f"array<{_PLACED}>").alias("placed"),
        F.array().cast("array<struct<i:int,storage:double>>").alias("sizes"),
    )
    widest = F.transform(
        F.arrays_zip("placed", "entries"), lambda z: z["placed"]["times"] * F.greatest(z["entries"]["length"], F.lit(1))
    )
    return (
        books.withColumn("passed", F.aggregate("entries", zero, _step))
        .withColumn("placed", F.col("passed.placed"))
        .withColumn("sizes", F.sort_array(F.concat("passed.sizes", F.transform("passed.open", _size))))
        .drop("passed")
        .withColumn("fits", F.aggregate(widest, F.lit(0.0), lambda a, x: a + x) <= LARGEST)
    )


def all_rejects(lines: DataFrame) -> DataFrame:
    """``copybook_id, line_no, statement, reject_reason`` of everything that is not in the layout table: statements
    skipped, and the repeated entries of copybooks that do not fit and are left out as a whole. One pass over the lines."""
    books = place_entries(gather_books(lines))
    oversized = F.when(F.col("fits"), F.slice("repeated", 1, 0)).otherwise(F.col("repeated"))
    return books.select("copybook_id", F.inline(F.concat("rejects", oversized)))


def add_family_keys(books: DataFrame) -> DataFrame:
    """``families``: for each entry a hash of what entries share that may take the same name: the record, the name
    but for numbers at its end, and how many numbers it ends with after expansion. ``shared_families``: the hashes
    that several entries have."""
    key = F.transform(
        F.arrays_zip("entries", "placed"),
        lambda z: F.xxhash64(
            z["placed"]["record_no"], z["entries"]["stem"], F.size(z["entries"]["numbers"]) + F.size(z["placed"]["repeats"])
        ),
    )
    shared = F.filter("ordered", lambda f, j: (j > 0) & (F.get("ordered", j - 1) == f))
    return (
        books.withColumn("families", key)
        .withColumn("ordered", F.sort_array("families"))
        .withColumn("shared_families", F.array_distinct(shared))
        .drop("ordered")
    )


def _rivals(i: Column) -> Column:
    """Entries of the family of the ``i``-th whose occurrences may take the same name. ``plain`` counts the earlier
    ones where neither is repeated, which take it surely."""

    def entry(k):
        return F.get("entries", k)

    def place(k):
        return F.get("placed", k)

    def rival(j):
        common = F.filter(F.array_intersect(place(i)["chain"], place(j)["chain"]), lambda c: entry(c)["occurs"] > 1)
        return F.struct(
            entry(j)["numbers"].alias("numbers"), place(j)["repeats"].alias("repeats"), F.size(common).alias("shared"), (j < i).alias("before")
        )

    def plainly(j):
        return (F.size(place(j)["repeats"]) == 0) & (F.size(place(i)["repeats"]) == 0)

    def compared(family):
        others = F.filter(family, lambda j: (j != i) & (entry(j)["stem"] == entry(i)["stem"]))
        return F.struct(
            F.size(F.filter(others, lambda j: plainly(j) & (j < i) & (entry(j)["numbers"] == entry(i)["numbers"]))).alias("plain"),
            F.transform(
                F.filter(others, lambda j: ~plainly(j) & ((j < i) | (entry(j)["numbers"] != entry(i)["numbers"]))), rival
            ).alias("rivals"),
        )

    def found(family):
        members = F.filter(F.transform("families", lambda f, j: F.when(f == family, j)), lambda j: j.isNotNull())
        alone = F.array().cast("array<int>")
        return _let(F.when(F.array_contains("shared_families", family), members).otherwise(alone), compared)

    return _let(F.get("families", i), found)


def explode_entries(books: DataFrame) -> DataFrame:
    """One row per entry, with ``steps``: for each chain element its line, repetitions, size of an occurrence, the
    product of the repetitions below it, and whether it moves the entry."""

    def row(p: Column, i: Column) -> Column:
        entry = F.get("entries", i)

        def step(c: Column, k: Column) -> Column:
            above = F.get("entries", c)
            size = F.when(above["is_group"], F.get("sizes", c)["storage"]).otherwise(above["length"].cast("double"))
            below = F.slice(p["chain"], k + 2, F.size(p["chain"]) - k - 1)
            return F.struct(
                above["line_no"].alias("line"),
                above["occurs"].alias("occurs"),
                F.when(F.array_contains(p["movers"], c), size).otherwise(0.0).cast("int").alias("size"),
                F.aggregate(below, F.lit(1), lambda total, b: total * F.get("entries", b)["occurs"]).alias("inner"),
            )

        return F.struct(
            p["record_no"].alias("record_no"),
            p["record_name"].alias("record_name"),
            p["parent"].alias("parent"),
            (p["region"] != NO_REGION).alias("in_redefinition"),
            p["first"].cast("int").alias("first"),
            F.transform(p["chain"], step).alias("steps"),
            F.get("sizes", i)["storage"].cast("int").alias("storage"),
            entry.alias("entry"),
            _rivals(i).alias("same"),
        )

    # a plain explode, or a filter before it, is planned with a test that makes all rows of the copybook once more
    rows = F.when(F.col("fits") & (F.size("entries") > 0), F.transform("placed", row))
    return (
        add_family_keys(books)
        .select("copybook_id", "copybook_name", F.explode_outer(rows).alias("e"))
        .where(F.col("e").isNotNull())
        .select("copybook_id", "copybook_name", "e.*")
        .select("*", "entry.*")
        .drop("entry")
    )


def expand_occurrences(entries: DataFrame) -> DataFrame:
    """One row per occurrence: ``at`` with the 0-based index of each chain element, from the mixed-radix number of the
    occurrence. Runs of ``RUN`` at a time, so that no row holds all of them."""
    first = F.element_at("steps", 1)
    last = (first["inner"] * first["occurs"] - 1).cast("long")
    run = F.least(F.col("last") - F.col("run") * RUN, F.lit(RUN - 1))
    at = F.transform(
        "steps",
        lambda s: F.struct(
            s["line"].alias("line"),
            s["occurs"].alias("occurs"),
            s["size"].alias("size"),
            (F.floor(F.col("n") / s["inner"]).cast("int") % s["occurs"]).alias("idx"),
        ),
    )
    return (
        entries.withColumn("last", last)
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / RUN))))
        .withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), run)))
        .withColumn("n", (F.col("n") + F.col("run") * RUN).cast("int"))
        .withColumn("at", at)
        .drop("last", "run")
    )


def _number_text(n: Column) -> Column:
    return F.format_string("%02d", n)


def _takes_same_name(rival: Column) -> Column:
    """Whether an occurrence of the rival that comes before this row has this row's name: the numbers at the end of
    the name agree with the rival's own ones, then with its repetitions; of shared groups the index decides."""
    own = F.size(rival["numbers"])
    fixed = F.slice("texts", 1, own) == rival["numbers"]
    chosen = F.transform(F.slice("texts", own + 1, F.size(rival["repeats"])), lambda t: t.try_cast("int"))
    reached = F.forall(
        F.arrays_zip(F.slice("texts", own + 1, F.size(rival["repeats"])).alias("t"), chosen.alias("n"), rival["repeats"].alias("r")),
        lambda z: F.coalesce(z["n"].between(1, z["r"]) & (_number_text(z["n"]) == z["t"]), F.lit(False)),
    )
    theirs = F.slice(chosen, 1, rival["shared"])
    mine = F.slice("indices", 1, rival["shared"])
    return fixed & reached & ((theirs < mine) | ((theirs == mine) & rival["before"]))


def _again(entries: DataFrame) -> DataFrame:
    """``field_name`` with its occurrence numbers, and numbered from 2 where a row before it in the record has it."""
    repeated = F.filter("at", lambda p: p["occurs"] > 1)
    again = F.lit(1) + F.col("same.plain") + F.when(
        F.size("same.rivals") > 0, F.size(F.filter("same.rivals", _takes_same_name))
    ).otherwise(0)
    return (
        entries.withColumn("indices", F.transform(repeated, lambda p: p["idx"] + 1))
        .withColumn("suffix", F.transform("indices", _number_text))
        .withColumn("texts", F.concat("numbers", "suffix"))
        .withColumn("again", again)
        .withColumn("field_name", F.array_join(F.concat(F.array("base_name"), "suffix"), "_"))
        .withColumn(
            "field_name",
            F.when(F.col("again") > 1, F.concat_ws("_", "field_name", F.col("again").cast("string"))).otherwise(F.col("field_name")),
        )
    )


def parse_copybooks(lines: DataFrame) -> DataFrame:
    """Copybook lines to the layout table (columns ``LAYOUT_COLUMNS``). Copybooks that do not fit are left out;
    ``all_rejects`` lists them."""
    rows = expand_occurrences(explode_entries(place_entries(gather_books(lines))))
    moved = F.aggregate("at", F.lit(0), lambda a, p: a + p["idx"] * p["size"])
    kind = F.when(~F.col("is_group"), "elementary").when(F.col("occurs") > 1, "group_occurrence").otherwise("group")
    placed = (
        rows.withColumn("kind", kind)
        .withColumn("start_pos", F.col("first") + moved + 1)
        .withColumn("length", F.when(F.col("kind") == "group_occurrence", F.col("storage")).otherwise(F.col("length")))
        .withColumn("end_pos", F.col("start_pos") + F.col("length") - 1)
        .withColumn("occ_path", F.flatten(F.transform("at", lambda p: F.array(p["line"], p["idx"]))))
        .withColumn("occurrence", F.col("n") + 1)
        .withColumn("base_name", F.col("field_name"))
    )
    return _again(placed).select(*LAYOUT_COLUMNS)


def record_lengths(layout: DataFrame) -> DataFrame:
    """Largest end position per copybook."""
    return layout.groupBy("copybook_id").agg(F.max("end_pos").alias("record_length"))


def parsing_summary(lines: DataFrame, layout: DataFrame) -> DataFrame:
    """``total_fields`` (entries as written), ``parsed_lines`` (statements
    kept) and ``record_length``, one row per copybook, zeros included."""
    parts = (
        lines.select("copybook_id")
        .unionByName(
            statements(lines).select("copybook_id", F.lit(1).alias("kept")), allowMissingColumns=True
        )
        .unionByName(
            layout.select("copybook_id", "end_pos", (F.col("occurrence") == 1).cast("int").alias("entry")),
            allowMissingColumns=True,
        )
    )
    zero = F.lit(0)
    return parts.groupBy("copybook_id").agg(
        F.coalesce(F.sum("entry"), zero).alias("total_fields"),
        F.coalesce(F.sum("kept"), zero).alias("parsed_lines"),
        F.coalesce(F.max("end_pos"), zero).alias("record_length"),
    )


def layout_columns(layout: DataFrame, include_group_slices: bool = False) -> DataFrame:
    """``copybook_id, ordinal, field_name, base_name, type``: the reader's columns, with the name as written."""
    kinds = ["elementary", "group_occurrence"] if include_group_slices else ["elementary"]
    order = W.partitionBy("copybook_id").orderBy("record_no", "occ_path")
    return layout.filter(F.col("kind").isin(kinds) & (F.col("length") > 0)).select(
        "copybook_id",
        F.row_number().over(order).alias("ordinal"),
        "field_name",
        "base_name",
        F.lit("string").alias("type"),
    )


def layout_schema(layout: DataFrame, include_group_slices: bool = False) -> DataFrame:
    """``copybook_id, ordinal, field_name, type``: the reader's columns."""
    return layout_columns(layout, include_group_slices).drop("base_name")


def layout_alignment(layout: DataFrame) -> DataFrame:
    """Gap or overlap of each elementary field with all fields before it. Needs
    ``copybook_id, record_name, field_name, start_pos, end_pos``; rows with
    ``in_redefinition`` true are left out."""
    if "in_redefinition" in layout.columns:
        layout = layout.filter(~F.col("in_redefinition"))
    if "kind" in layout.columns:
        layout = layout.filter(F.col("kind") == "elementary")
    order = W.partitionBy("copybook_id", "record_name").orderBy("start_pos", "end_pos", "field_name")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    distance = F.col("start_pos") - F.col("previous_end") - 1
    return (
        layout.withColumn("previous_end", F.max("end_pos").over(before))
        .withColumn("distance", F.when(F.col("previous_end").isNotNull(), distance).otherwise(0))
        .select(
            "copybook_id",
            "record_name",
            "field_name",
            "start_pos",
            "end_pos",
            "distance",
            F.when(F.col("distance") > 0, "gap")
            .when(F.col("distance") < 0, "overlap")
            .otherwise("ok")
            .alias("alignment"),
        )
    )


def array_fields(columns: DataFrame) -> DataFrame:
    """Repeated fields recognised by a ``_digits`` ending, grouped by the name
    before it. Needs ``copybook_id, field_name``."""
    split = r"^(.*)_\d+$"
    return (
        columns.filter(F.col("field_name").rlike(split))
        .groupBy("copybook_id", F.regexp_extract("field_name", split, 1).alias("base_name"))
        .agg(F.count("*").alias("columns"))
    )


def fields_to_compare(
    columns: DataFrame, ignore: Iterable[str] = (), keys: Iterable[str] = ()
) -> DataFrame:
    """Compared columns per copybook in layout order: everything that is not
    on the ignore list (own or base name); ``is_key`` marks the keys. Needs
    ``copybook_id, ordinal, field_name, base_name``."""
    ignored, key_names = list(ignore), list(keys)
    kept = ~(F.col("field_name").isin(ignored) | F.col("base_name").isin(ignored))
    return columns.filter(kept).select(
        "copybook_id",
        "ordinal",
        "field_name",
        F.col("field_name").isin(key_names).alias("is_key"),
    )
