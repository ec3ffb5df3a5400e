"""Jobs over scripts, exported documents and view definitions.

One document is one row, so work inside a document stays in that row (arrays and higher-order functions)
wherever possible and needs no shuffle. Lines or cells are exploded only to join them with a table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from viewloom.functions import scalar as fn, text as tx
from viewloom.operators.metadata import describe_fields
from viewloom.operators.relational import group_members
from viewloom.operators.scans import Ordering, numbered
from viewloom.session import materialize

# --- scripts ----------------------------------------------------------------------------------


def split_statements(df: DataFrame, script: str, text: str, blocks: bool = False) -> DataFrame:
    """Numbered statements of each script; ``blocks`` splits on ``;`` plus blank line and keeps the ``;``."""
    parts = tx.statement_blocks(F.col(text)) if blocks else tx.statements(F.col(text))
    exploded = df.select(F.col(script), F.posexplode(parts).alias("stmt_no", "stmt"))
    return exploded.withColumn("stmt_no", F.col("stmt_no") + 1)


def apply_mapping(
    scripts: DataFrame, text: str, mapping: DataFrame, whole_words: bool = True, slice_size: int = 2000
) -> DataFrame:
    """Replace the ``key`` of every mapping row by its ``value``, in order of ``ordinal``.

    Later replacements see the results of earlier ones. Whole words are found regardless of case, plain keys exactly.

    Whole words: a key can only apply where its first word is a word of the script, or of a value that an earlier entry may have put there. Such
    pairs are found by equality of words, and each script is worked on with its own few entries. Keys that begin or end with something other
    than a word character may join their value to a neighbouring word; scripts they may apply to are tested against all entries, which reach
    them as scalar subqueries of at most ``slice_size`` entries, slice after slice.

    Plain keys: a script meets the keys one of whose q-grams it has. What replacements put together is searched for further keys until there are none.
    Entries with an empty key, or without key or value, change nothing.
    """
    placed = numbered(
        mapping.select(F.lit(1).alias("__all"), "ordinal", "key", "value"),
        Ordering(("__all",), ("ordinal", "key"), chunk=F.floor(F.col("ordinal") / 100_000)),
        "__no",
    )
    placed = materialize(placed.drop("__all"), "mapping")
    if not whole_words:
        return _apply_plain(scripts, text, placed.where("key <> '' and value is not null"))
    reach = materialize(_word_reach(placed), "reach")
    numbered_scripts = _with_number(scripts)
    # the empty word stands for keys without any: they may apply everywhere
    words = numbered_scripts.select("__script", F.explode(F.concat(_words(F.col(text)), F.array(F.lit("")))).alias("__word"))
    due = words.join(reach, "__word").groupBy("__script").agg(F.max("open").alias("__open"), F.collect_set("__no").alias("nos"))
    due = materialize(due, "due")
    pairs = due.filter(~F.col("__open")).select("__script", F.explode("nos").alias("__no"))
    entries = pairs.join(placed.select("__no", "key", "value"), "__no").groupBy("__script")
    entries = entries.agg(F.array_sort(F.collect_list(F.struct("__no", "key", "value"))).alias("__entries"))
    unready = due.filter("__open").select("__script", "__open")
    joined = numbered_scripts.join(entries, "__script", "left").join(unready, "__script", "left")
    folded = F.aggregate(F.coalesce("__entries", F.array().cast(entries.schema["__entries"].dataType)), F.col(text), _replace_word)
    plain = joined.filter("__open is null").withColumn(text, folded).select(*scripts.columns)
    whole = joined.filter("__open").select(*scripts.columns)
    return plain.unionByName(_apply_slices(whole, text, placed, slice_size)) if not unready.isEmpty() else plain


def _with_number(scripts: DataFrame) -> DataFrame:
    return materialize(scripts.withColumn("__script", F.monotonically_increasing_id()), "scripts")


#: Lengths of the q-grams that stand for a plain key: the longest that fits.
_GRAMS = (16, 8, 4, 2, 1)


def _grams(c: Column, q: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{q}}}))"), 1))


def _key_grams(placed: DataFrame) -> DataFrame:
    """(__no, q, gram): of each key's grams the one that the fewest keys have."""
    length = F.char_length("key")
    q = F.coalesce(*[F.when(length >= n, n) for n in _GRAMS])
    grams = F.coalesce(*[F.when(length >= n, _grams(F.col("key"), n)) for n in _GRAMS])
    each = placed.select("__no", q.alias("q"), F.explode(grams).alias("gram"))
    common = each.groupBy("gram").agg(F.count(F.lit(1)).alias("keys"))
    return each.join(common, "gram").groupBy("__no", "q").agg(F.min_by("gram", F.struct("keys", "gram")).alias("gram"))


def _apply_plain(scripts: DataFrame, text: str, placed: DataFrame) -> DataFrame:
    """Replace plain keys in order, each script with the keys that can occur in it.

    A key outside that list would have to appear in a text that the list's own replacements make: such texts are looked at as well, and a script for
    which they bring further keys is worked on again with these. The rounds end when no text in between has a new key.
    """
    index = materialize(_key_grams(placed), "grams")
    lengths = [r.q for r in index.select("q").distinct().collect()]
    # a key comes up anew only with a character of some value in its q-gram, or where an empty value joins two ends
    brought = placed.select(F.explode(F.split("value", "")).alias("c")).where("c <> ''").distinct()
    letters = index.select("__no", F.explode(F.split("gram", "")).alias("c")).join(brought, "c").select("__no").distinct()
    joins_ends = not placed.where("value = ''").isEmpty()
    later = index if joins_ends else materialize(index.join(letters, "__no", "left_semi"), "later")
    final = later.isEmpty()
    stored = _with_number(scripts.withColumn("__text", F.col(text)))
    if not lengths:
        return scripts

    def met(texts: DataFrame, keys: DataFrame) -> DataFrame:
        grams = F.flatten(F.array(*[_grams(F.col("__text"), q) for q in lengths]))
        return texts.select("__script", F.explode(grams).alias("gram")).join(keys, "gram").select("__script", "__no").distinct()

    start = F.struct(F.col("__text").alias("text"), F.array().cast("array<string>").alias("made"))

    def replace(state: Column, entry: Column) -> Column:
        new = F.struct(F.replace(state["text"], entry["key"], entry["value"]).alias("text"), F.array_append(state["made"], state["text"]).alias("made"))
        return F.when(F.contains(state["text"], entry["key"]), new).otherwise(state)

    known = pairs = materialize(met(stored, index), "pairs")
    results = []
    while True:
        entries = pairs.join(placed.select("__no", "key", "value"), "__no").groupBy("__script").agg(
            F.array_sort(F.collect_list(F.struct("__no", "key", "value"))).alias("entries")
        )
        folded = F.aggregate("entries", start, replace)
        done = materialize(stored.select("__script", "__text").join(entries, "__script").select("__script", folded.alias("done")), "folded")
        if final:
            results.append(done)
            break
        # the first text made is the script itself
        made = F.filter(F.array_append("done.made", F.col("done.text")), lambda _, i: i > 0)
        further = met(done.select("__script", F.explode(made).alias("__text")), later).join(known, ["__script", "__no"], "left_anti")
        further = materialize(further, "pairs")
        again = further.select("__script").distinct()
        results.append(done.join(again, "__script", "left_anti"))
        if further.isEmpty():
            break
        known = known.union(further)
        pairs = materialize(known.join(again, "__script", "left_semi"), "pairs")
    changed = reduce(DataFrame.unionByName, results).select("__script", F.col("done.text").alias("__new"), F.lit(True).alias("__done"))
    replaced = F.when(F.col("__done"), F.col("__new")).otherwise(F.col(text))
    return stored.join(changed, "__script", "left").withColumn(text, replaced).select(*scripts.columns)


def _words(c: Column) -> Column:
    """The distinct words of a text, folded as a search without case folds them."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"(?U)(\w+)"), 1), lambda w: F.lower(F.upper(w))))


def _word_reach(placed: DataFrame) -> DataFrame:
    """(word, number of an entry, open): what may apply once the word stands in a script, through values too."""
    first = F.get(_words(F.col("key")), F.lit(0))
    edged = F.rlike("key", F.lit(r"(?U)^\W|\W$"))
    entries = placed.select("__no", first.alias("__word"), edged.alias("open"), _words(F.col("value")).alias("brought"))
    entries = materialize(entries.withColumn("__word", F.coalesce("__word", F.lit(""))), "entries")
    heads = entries.select("__word", "__no", "open")
    found = [heads]
    frontier = heads
    while True:
        brought = frontier.select(F.col("__word").alias("start"), "__no").join(entries.select("__no", F.explode("brought").alias("__word")), "__no")
        further = brought.select("start", "__word").distinct().join(heads, "__word").select(F.col("start").alias("__word"), "__no", "open").distinct()
        known = reduce(DataFrame.unionByName, found)
        frontier = materialize(further.join(known, ["__word", "__no"], "left_anti"), "reach")
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, found)
        found.append(frontier)


def _replace_word(text_so_far: Column, entry: Column) -> Column:
    word = F.concat(F.lit(r"(?iuU)\b\Q"), entry["key"], F.lit(r"\E\b"))
    literal = F.regexp_replace(entry["value"], r"([\\$])", r"\\$1")
    # the cheap test spares the regular expression for keys that do not occur at all
    occurs = F.contains(F.lower(text_so_far), F.lower(entry["key"]))
    return F.when(occurs, F.regexp_replace(text_so_far, word, literal)).otherwise(text_so_far)


def _apply_slices(scripts: DataFrame, text: str, placed: DataFrame, slice_size: int) -> DataFrame:
    for number in range(math.ceil(placed.count() / slice_size)):
        inside = (F.col("__no") > number * slice_size) & (F.col("__no") <= (number + 1) * slice_size)
        entries = placed.filter(inside).agg(F.array_sort(F.collect_list(F.struct("__no", "key", "value"))))
        with_entries = scripts.withColumn("__entries", entries.scalar())
        scripts = with_entries.withColumn(text, F.aggregate("__entries", F.col(text), _replace_word)).drop("__entries")
        if number % 20 == 19:
            scripts = materialize(scripts, "scripts")  # keeps the plan short for very long mappings
    return scripts


# Fixed value: a line of a column list, after trimming: name, type, optional comma.
_FIELD_LINE = r"^(\w+)\s+(.+?)(?:,\s*)?$"


def annotate_ddl(df: DataFrame, doc: str, text: str, descriptions: DataFrame) -> DataFrame:
    """Append ``COMMENT('description')`` to the column lines of DDL scripts that have a description.

    Indent and comma stay. Result: document, text, and the numbers of comments added and fields seen. The
    ``CREATE TABLE`` line looks like a field and is counted as one.
    """
    lines = df.select(F.col(doc), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"\s+$", ""))
    trimmed = F.regexp_replace("line", r"^\s+", "")
    name = F.regexp_extract(trimmed, _FIELD_LINE, 1)
    parsed = lines.withColumns(
        {"field": name, "type": F.regexp_replace(F.regexp_extract(trimmed, _FIELD_LINE, 2), r"[,\s]+$", "")}
    )
    # lines without a field take no part in the join, where they would all share one empty key
    described = describe_fields(parsed.filter("field <> ''"), "field", descriptions)
    indent = F.regexp_extract("line", r"^\s*", 0)
    padded = F.rpad("field", F.greatest(F.length("field"), F.lit(18)), F.lit(" "))
    comma = F.when(F.endswith("line", F.lit(",")), ",").otherwise("")
    comment = F.concat(indent, padded, F.lit(" "), "type", F.lit(" COMMENT('"), "description", F.lit("')"), comma)
    fields = described.withColumn("line", F.coalesce(comment, "line"))
    others = parsed.filter("field = ''").withColumn("description", F.lit(None).cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return fields.unionByName(others).groupBy(doc).agg(
        F.array_join(F.transform(ordered, lambda entry: entry["line"]), "\n").alias(text),
        F.count("description").alias("comments_added"),
        F.count_if(F.col("field") != "").alias("fields_processed"),
    )


def classify_statements(df: DataFrame, statement: str) -> DataFrame:
    tag = F.when(tx.needs_review(F.col(statement)), "REVIEW").otherwise("ONLY_SELECT")
    return df.withColumn("tag", tag)


# --- exported documentation -------------------------------------------------------------------


def _closed_table(rest: Column) -> Column:
    """The text behind an opened table up to the end tag that closes it; tables inside stay whole.

    One pass over the end tags, with the tables open so far as state.
    """

    def close(pieces: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("last"))

        def step(state: Column, piece: Column) -> Column:
            # tables opened in the piece, less the one that is closed behind it
            depth = state["depth"] + F.size(F.split(piece, "(?i)<table")) - 2
            at = state["at"] + 1
            last = F.when((state["last"] == 0) & (depth <= 0), at).otherwise(state["last"])
            return F.struct(depth.alias("depth"), at.alias("at"), last.alias("last"))

        last = F.aggregate(pieces, start, step, lambda state: F.when(state["last"] > 0, state["last"]).otherwise(state["at"]))
        return F.array_join(F.slice(pieces, F.lit(1), last), "</table>")

    return F.get(F.transform(F.array(F.split(rest, "(?i)</table>")), close), F.lit(0))


def table_rows(df: DataFrame, doc: str, html: str) -> DataFrame:
    """Three-cell rows of the grid table behind its header; a blank object type repeats the one above.

    The grid is the first table with the grid class among its classes, up to the end tag that closes it. Tables inside a cell are part of its text.
    All work stays in the row of a document and grows with its length.
    """
    opening = rf"""(?is)<table[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{tx.GRID_CLASS}(?:\s[^"']*)?["'][^>]*>"""
    inside = _closed_table(F.get(F.split(html, opening, 2), F.lit(1)))
    # tables inside cells give way to their text, so that their rows are not rows of the grid
    grid = F.regexp_replace(inside, r"(?is)<table[^>]*>(.*?)</table>", "\u0001$1\u0002")
    grid = F.transform(F.split(grid, "\u0001"), lambda p, i: F.when(i == 0, p).otherwise(_flat_before(p)))
    rows = F.regexp_extract_all(F.array_join(grid, ""), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(
        F.filter(rows, lambda _, i: i > 0),
        lambda row: F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1), tx.plain_text),
    )

    def filled(found: Column) -> Column:
        """Rows cut into runs that begin with an object type; every run is a slice, so each row is copied once."""

        def runs(starts: Column) -> Column:
            def run(start: Column, i: Column) -> Column:
                end = F.coalesce(F.get(starts, i + 1), F.size(found) + 1)
                kind = F.get(F.get(found, start - 1), F.lit(0))
                member = lambda c: F.struct(kind.alias("object_type"), F.get(c, F.lit(1)).alias("name"), F.get(c, F.lit(2)).alias("technical_name"))
                return F.transform(F.slice(found, start, end - start), member)

            return F.flatten(F.transform(starts, run))

        begins = F.filter(F.transform(found, lambda c, i: F.when((i == 0) | (F.get(c, F.lit(0)) != ""), i + 1)), lambda i: i.isNotNull())
        return F.get(F.transform(F.array(begins), runs), F.lit(0))

    complete = F.filter(cells, lambda c: F.size(c) == 3)
    placed = F.get(F.transform(F.array(complete), filled), F.lit(0))
    exploded = df.select(F.col(doc), F.posexplode(placed).alias("row_no", "c"))
    return exploded.select(doc, (F.col("row_no") + 1).alias("row_no"), "c.*")


def _flat_before(piece: Column) -> Column:
    """Markup of an inner table, up to its end mark, as blanks."""
    ends = F.split(piece, "\u0002", 2)
    marked = F.regexp_replace(F.get(ends, F.lit(0)), "<[^>]*>", "\u0003")
    blank = F.regexp_replace(marked, r"(?<!\s)\s*+\x03[\s\x03]*+", " ")
    return F.concat(blank, F.coalesce(F.get(ends, F.lit(1)), F.lit("")))


def split_source(rows: DataFrame) -> DataFrame:
    """For HANA data sources: technical name, source system and the view name at the end of the name."""
    kind, technical = F.lower("object_type"), F.lower("technical_name")
    hana = F.contains(kind, F.lit("data")) & F.contains(kind, F.lit("source")) & F.contains(technical, F.lit("hana"))
    words = F.split(F.trim(F.regexp_replace("technical_name", r"\s+", " ")), " ", 2)
    # Fixed value: delimiters of the display name
    tokens = F.filter(F.split(F.regexp_replace("name", "[/:->]", " "), r"\s+"), lambda w: w != "")
    return rows.withColumns(
        {
            "technical_name": F.when(hana, F.get(words, F.lit(0))).otherwise(F.col("technical_name")),
            "source_system": F.when(hana, F.coalesce(F.trim(F.get(words, F.lit(1))), F.lit(""))).otherwise(""),
            "hana_view": F.when(hana, F.try_element_at(tokens, F.lit(-1))).otherwise(""),
        }
    )


def transformation_names(rows: DataFrame, doc: str) -> DataFrame:
    found = rows.filter(F.contains(F.lower("object_type"), F.lit("transformation")))
    return found.select(doc, F.col("technical_name").alias("name"))


def anchored_sections(df: DataFrame, doc: str, html: str, names: DataFrame) -> DataFrame:
    """Section table around the first anchor of each (document, name).

    A document is cut at the section tables; a section ends where its own table is closed, so tables
    inside it stay whole.
    """
    pieces = F.split(html, r"(?i)\Q" + tx.SECTION_TABLE + r"\E")
    sections = df.select(F.col(doc), F.posexplode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("no", "rest"))
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("depth"))

    def close(state: Column, piece: Column) -> Column:
        depth = state["depth"] + F.size(F.split(piece, "(?i)<table")) - 2
        more = F.struct(F.concat(state["text"], piece, F.lit("</table>")).alias("text"), depth.alias("depth"))
        return F.when(state["depth"] > 0, more).otherwise(state)

    whole = F.aggregate(F.split("rest", "(?i)</table>"), start, close, lambda state: state["text"])
    sections = sections.select(doc, "no", F.concat(F.lit(tx.SECTION_TABLE), whole).alias("section"))
    anchors = F.regexp_extract_all("section", F.lit('(?is)<a[^>]*name="TRFN([^"]*)"'), 1)
    anchored = sections.select(doc, F.explode(F.array_distinct(anchors)).alias("name"), "no", "section")
    first = anchored.groupBy(doc, "name").agg(F.min_by("section", "no").alias("section"))
    return names.distinct().join(first, [doc, "name"], "inner").select(doc, "name", "section")


# Labels of the description block of a transformation and what follows each.
_LABELS = {
    "technical_name": ("Technical Name: ", " Description (Short): "),
    "short_description": ("Description (Short): ", " Description (Long): "),
    "long_description": ("Description (Long): ", " Object Version: "),
    "source": ("Source: ", " Target: "),
    "routine": ("Routine ", " Required Objects Object Type Name Technical Name Routine"),
}
_TARGET_LABEL, TARGET_LENGTH = "Target: ", 20


def labelled_fields(df: DataFrame, doc: str, text: str, target_length: int = TARGET_LENGTH) -> DataFrame:
    """Values between the labels of a description block; NULL where a label is missing.

    Nothing ends the target, the last field: its first ``target_length`` characters are taken.
    """
    values = [tx.between(F.col(text), a, b).alias(name) for name, (a, b) in _LABELS.items()]
    return df.select(doc, *values, tx.after(F.col(text), _TARGET_LABEL, target_length).alias("target"))


# Columns of a rule table in order.
RULE_COLUMNS = (
    "Logic",
    "Field_name",
    "Description",
    "Data_Type",
    "Length",
    "Rule_Type",
    "Target",
    "InfoObject",
    "Description1",
    "Data_Type1",
    "Length1",
)


def rule_cells(df: DataFrame, doc: str, html: str, out: str = "cells") -> DataFrame:
    """Rows of a rule table as arrays of cells, at least as wide as the rule columns; blank cells are NULL.

    A cell that spans columns stands in each of them, a cell alone in its row in all. Narrower rows, such as those of the two-column form
    (Logic, Field_name), are filled up with NULL; wider ones stay as they are.
    """
    width = len(RULE_COLUMNS)
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)

    def expanded(row: Column) -> Column:
        tags, texts = (F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]([^>]*)>(.*?)</t[dh]>"), k) for k in (1, 2))
        cells = F.arrays_zip(tags.alias("tag"), texts.alias("text"))

        def span(cell: Column) -> Column:
            asked = F.regexp_extract(cell["tag"], r"(?i)\bcolspan\s*=\s*[\"']?([0-9]{1,3})\b", 1)
            times = F.greatest(F.coalesce(F.nullif(asked, F.lit("")).cast("int"), F.lit(1)), F.lit(1))
            return F.array_repeat(F.nullif(tx.plain_text(cell["text"]), F.lit("")), times)

        return F.flatten(F.transform(cells, span))

    def filled(c: Column) -> Column:
        padding = F.array_repeat(F.lit(None).cast("string"), F.greatest(F.lit(width) - F.size(c), F.lit(0)))
        return F.when(F.size(c) == 1, F.array_repeat(F.get(c, F.lit(0)), width)).otherwise(F.concat(c, padding))

    spread = F.filter(F.transform(rows, expanded), lambda c: F.size(c) > 0)
    return df.select(doc, F.transform(spread, filled).alias(out))


def tidy_rules(df: DataFrame, doc: str, cells: str = "cells") -> DataFrame:
    """Rules of a transformation with the logic written under them.

    Unit rows and rows without any field are dropped. A row with one text in all columns is a note: it
    becomes the Logic of the rule above, also past one row without rule type, and a second note about a
    constant is appended. The last two rows describe the transformation and are not rules.
    """
    at = {name: F.lit(i) for i, name in enumerate(RULE_COLUMNS)}

    def wanted(row: Column) -> Column:
        field, info = F.get(row, at["Field_name"]), F.get(row, at["InfoObject"])
        unit = F.coalesce(F.startswith(field, F.lit("Unit Info")), F.lit(False))
        return ~unit & (field.isNotNull() | info.isNotNull())

    kept = df.select(doc, F.filter(cells, wanted).alias("kept"))
    body = F.slice("kept", 1, F.greatest(F.size("kept") - 2, F.lit(0)))
    # per row: its cells, the note it is, and whether it has a rule type
    parsed = F.transform(
        body,
        lambda row: F.struct(
            row.alias("row"),
            F.when(F.size(F.array_distinct(row)) == 1, F.get(row, F.lit(0))).alias("note"),
            F.get(row, at["Rule_Type"]).isNotNull().alias("typed"),
        ),
    )
    rows = kept.select(doc, parsed.alias("rows"))

    def note(i: Column, steps: int) -> Column:
        first, second = F.get("rows", i + steps)["note"], F.get("rows", i + steps + 1)["note"]
        constant = F.when(F.contains(second, F.lit("Constant")), F.concat(F.lit("\n"), second))
        return F.concat(first, F.coalesce(constant, F.lit("")))

    def with_logic(entry: Column, i: Column) -> Column:
        past_typeless = F.when(~F.get("rows", i + 1)["typed"], note(i, 2))
        found = F.when(entry["typed"], F.coalesce(note(i, 1), past_typeless))
        return F.struct(entry["note"].alias("note"), entry["row"].alias("row"), found.alias("logic"))

    rules = F.filter(F.transform("rows", with_logic), lambda entry: entry["note"].isNull())
    exploded = rows.select(doc, F.posexplode(rules).alias("rule_no", "entry"))
    logic = F.coalesce("entry.logic", F.get("entry.row", at["Logic"])).alias("Logic")
    others = [F.get("entry.row", at[name]).alias(name) for name in RULE_COLUMNS[1:]]
    return exploded.select(doc, (F.col("rule_no") + 1).alias("rule_no"), logic, *others)


# --- view definitions -------------------------------------------------------------------------


def pack_by_budget(df: DataFrame, doc: str, sizes: str, base: Column, budget: int) -> DataFrame:
    """Pack the pieces of a document, in order, into groups that fit a budget.

    ``sizes`` is the array of piece sizes and ``base`` what every group costs beforehand. A new group
    starts when the next piece would pass the budget; a single piece may be larger than it.
    """
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("breaks")
    )

    def place(state: Column, size: Column) -> Column:
        full = (state["at"] > 0) & (base + state["used"] + size > budget)
        used = F.when(full, F.lit(0)).otherwise(state["used"]) + size
        # only a new group touches the array, so it is not copied at every piece
        breaks = F.when(full, F.array_append(state["breaks"], state["at"])).otherwise(state["breaks"])
        return F.struct((state["at"] + 1).alias("at"), used.cast("long").alias("used"), breaks.alias("breaks"))

    breaks = F.aggregate(sizes, start, place, lambda state: state["breaks"])
    edges = F.concat(F.array(F.lit(0)), breaks, F.array(F.size(sizes)))
    lengths = F.transform(F.slice(edges, F.lit(2), F.size(edges) - 1), lambda end, i: end - F.get(edges, i))
    groups = F.flatten(F.transform(lengths, lambda n, i: F.array_repeat(i + 1, n)))
    zipped = F.arrays_zip(groups.alias("group_no"), F.col(sizes).alias("size"))
    placed = df.select(F.col(doc), F.posexplode(zipped).alias("piece_no", "z"))
    return placed.select(doc, (F.col("piece_no") + 1).alias("piece_no"), "z.group_no", "z.size")


# Names of the elements and attributes read, in both dialects of view definitions (namespace prefixes are ignored).
_VIEW_XML = """
calculationViews struct<calculationView: array<struct<
    _id: string, _type: string, _joinType: string, filter: string,
    input: array<struct<_node: string, mapping: array<struct<_target: string, _source: string>>>>,
    joinAttribute: array<struct<_name: string>>,
    calculatedViewAttributes: struct<calculatedViewAttribute: array<struct<_id: string, formula: string>>>>>>,
viewNode array<struct<
    _name: string, _type: string, filterExpression: struct<formula: string>,
    input: array<struct<viewNode: struct<_VALUE: string>, entity: struct<_VALUE: string>, mapping: array<struct<_targetName: string, _sourceName: string>>>>,
    join: array<struct<_joinType: string, leftElementName: array<string>, rightElementName: array<string>>>,
    elementFilter: array<struct<_elementName: string, valueFilter: struct<_value: string, operands: array<struct<_value: string>>>>>,
    element: array<struct<_name: string, calculationDefinition: struct<formula: string>>>>>"""


def _item(item: str, name: Column, value: Column) -> Column:
    return F.struct(F.lit(item).alias("item"), name.cast("string").alias("name"), value.cast("string").alias("value"))


def _items(c: Column, make) -> Column:
    """One item per entry of an array that may be missing."""
    return F.coalesce(F.transform(c, make), F.array().cast("array<struct<item:string,name:string,value:string>>"))


def _nested(c: Column, inner: str, make) -> Column:
    return F.coalesce(F.flatten(F.transform(c, lambda x: _items(x[inner], make))), F.array().cast("array<struct<item:string,name:string,value:string>>"))


def view_items(df: DataFrame, doc: str, xml: str) -> DataFrame:
    """Contents of view definitions in both dialects: (doc, node_no, node, kind, item_no, item, name, value).

    Items of a node, in this order: its ``join`` (name: type), each ``input`` (name), each ``mapping`` (name: target, value: source),
    each ``join key`` (name; value: the right side where it is named), each ``filter`` (name: element; value: expression, value or list) and each
    ``calculation`` (name, value: formula). A node without items has one row with a NULL item. The documents are parsed as XML, so comments, quotes and
    entities are what they are there; what is no such document has no rows.
    """
    parsed = df.select(F.col(doc), F.from_xml(F.col(xml), _VIEW_XML, {"ignoreNamespace": "true"}).alias("v"))
    none = F.lit(None).cast("string")

    def scenario(n: Column) -> Column:
        joins = F.when(n["_joinType"].isNotNull(), F.array(_item("join", n["_joinType"], none)))
        filters = F.when(n["filter"].isNotNull(), F.array(_item("filter", none, n["filter"])))
        items = [
            _items(joins, lambda x: x),
            _items(n["input"], lambda i: _item("input", F.regexp_replace(i["_node"], "^#", ""), none)),
            _nested(n["input"], "mapping", lambda m: _item("mapping", m["_target"], m["_source"])),
            _items(n["joinAttribute"], lambda a: _item("join key", a["_name"], none)),
            _items(filters, lambda x: x),
            _items(n["calculatedViewAttributes"]["calculatedViewAttribute"], lambda a: _item("calculation", a["_id"], a["formula"])),
        ]
        return F.struct(n["_id"].alias("node"), n["_type"].alias("type"), F.concat(*items).alias("items"))

    def column_view(n: Column) -> Column:
        filters = F.when(n["filterExpression"].isNotNull(), F.array(_item("filter", none, n["filterExpression"]["formula"])))
        keys = F.transform(n["join"], lambda j: F.transform(F.arrays_zip(j["leftElementName"].alias("l"), j["rightElementName"].alias("r")), lambda z: _item("join key", z["l"], z["r"])))
        values = lambda f: F.coalesce(f["valueFilter"]["_value"], F.array_join(F.transform(f["valueFilter"]["operands"], lambda o: o["_value"]), ","))
        computed = F.filter(n["element"], lambda e: e["calculationDefinition"].isNotNull())
        items = [
            _items(n["join"], lambda j: _item("join", j["_joinType"], none)),
            _items(n["input"], lambda i: _item("input", F.regexp_replace(F.coalesce(i["viewNode"]["_VALUE"], i["entity"]["_VALUE"]), "^#", ""), none)),
            _nested(n["input"], "mapping", lambda m: _item("mapping", m["_targetName"], m["_sourceName"])),
            _items(F.flatten(F.filter(keys, lambda k: k.isNotNull())), lambda x: x),
            _items(filters, lambda x: x),
            _items(n["elementFilter"], lambda f: _item("filter", f["_elementName"], values(f))),
            _items(computed, lambda e: _item("calculation", e["_name"], e["calculationDefinition"]["formula"])),
        ]
        return F.struct(n["_name"].alias("node"), n["_type"].alias("type"), F.concat(*items).alias("items"))

    nodes = F.coalesce(F.transform("v.calculationViews.calculationView", scenario), F.transform("v.viewNode", column_view))
    exploded = parsed.select(doc, F.posexplode(nodes).alias("node_no", "n"))
    rows = exploded.select(
        doc, (F.col("node_no") + 1).alias("node_no"), F.col("n.node").alias("node"),
        F.regexp_extract("n.type", r"(?:\w+:)?(\w+?)(?:View|Node)?$", 1).alias("kind"), F.posexplode_outer("n.items").alias("item_no", "i"),
    )
    return rows.select(doc, "node_no", "node", "kind", (F.col("item_no") + 1).alias("item_no"), "i.*")


def word_sizes(c: Column, separator: str = r"\n") -> Column:
    """Number of words per line of a text, as sizes for :func:`pack_by_budget`."""
    return F.transform(F.split(c, separator), lambda line: tx.word_count(line).cast("long"))


def combined_name(c: Column) -> Column:
    """Short name of a member of a group: the last two parts of its file name without suffix."""
    parts = F.split(fn.part(c, r"\.", 0), "_")
    return F.concat_ws("_", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)))
