"""Column usage of SQL statements (T14): tokens in scopes.

A statement becomes rows of tokens. Running sums over its parentheses give every token its select scope (subselect, CTE, branch of a
union), a running value the clause it stands in. References are then matched with the sources of their own or an enclosing scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from viewloom.operators.relational import group_members
from viewloom.session import materialize

# Words that are no names, and those that begin a clause.
_CLAUSES = "select from join on using where group order having limit with".split()
_WORDS = _CLAUSES + (
    "as and or not in is null like between exists case when then else end distinct all by asc desc inner left right full outer cross "
    "natural lateral recursive union except intersect minus over partition rows range any true false interval create replace view table insert into values"
).split()
_SETS = ["union", "except", "intersect", "minus"]
# Names may be quoted, qualified, and have a namespace between slashes; a slash behind an operand divides.
_PART = r'(?:(?<![\w)])/\w+/)?[\w$#]+|"[^"]*"'
_TOKEN = rf"((?:{_PART})(?:\.(?:/\w+/)?(?:{_PART}|\*))*|[<({{}})>]|[^\s\w])"
# A parenthesis stands for its contents in the outer scope as well: { ( ... ) }. That of a subselect is written < ( ... ) }.
_OPEN, _QUERY, _CLOSE = "{", "<", "}"


def _tokens(statement: Column) -> Column:
    """Lower-case tokens without comments; literals are empty ones."""
    c = F.lower(statement)
    c = F.regexp_replace(c, r"'[^']*'|--[^\n]*|(?s)/\*.*?\*/", " ' ")
    c = F.regexp_replace(c, r"[{}<>]", " = ")
    c = F.regexp_replace(c, r"\((?=[\s(]*(?:select|with)\b)", f" {_QUERY} ( ")
    c = F.regexp_replace(c, rf"(?<!{_QUERY} )\(", f" {_OPEN} ( ")
    c = F.regexp_replace(c, r"\)", f" ) {_CLOSE} ")
    return F.regexp_extract_all(c, F.lit(_TOKEN), 1)


def _is(c: str, *values: str) -> Column:
    return F.col(c).isin(*values)


def _name(c: str) -> Column:
    return F.rlike(c, F.lit(r'^(?:"|/\w|[\p{L}_$#])')) & ~_is(c, *_WORDS)


def _neighbours(tokens: Column) -> Column:
    """Tokens that matter with their neighbours in the text; the marks of parentheses make these neighbours in their scope, too."""

    def rows(found: Column) -> Column:
        at = lambda i: F.get(found, i)
        return F.transform(
            found,
            lambda token, i: F.struct(
                i.alias("pos"), token.alias("token"), at(i - 1).alias("before"), at(i - 3).alias("before3"), at(i + 1).alias("after"), at(i + 2).alias("after2")
            ),
        )

    # as a variable of a lambda the tokens are found once, not once for every neighbour
    placed = F.flatten(F.transform(F.array(tokens), rows))
    return F.filter(placed, lambda r: F.rlike(r["token"], F.lit(r'^["/\p{L}_$#]..*|^[\p{L}_]|^[()<},]')))


def _marks() -> dict[str, Column]:
    """What a token and its neighbours tell without the scope. Found once, before the running values: these carry marks instead of texts,
    and conditions on the scope stay small enough for compiled code.
    """
    no = F.lit(False)
    lead = ["from", "join", "lateral", "only", ","]
    behind = _name("before") | F.rlike("before", F.lit(r"^\d")) | _is("before", ")", _CLOSE, "'", "end")
    marks = {
        "name": _name("token"),
        "dotted": F.contains("token", F.lit(".")),
        "call": _is("after", _OPEN),
        "unit": _is("after", "from"),
        "leads": _is("before", *lead[:-1]) | (_is("before", "(") & _is("before3", *lead, "(")),
        "comma": _is("before", ","),
        "listed": _is("before", "with", "recursive", ","),
        "named_as": _is("before", "as"),
        "behind": behind,
    }
    given = F.when(_is("after", "as"), F.col("after2")).when(_name("after") & ~F.contains("after", F.lit(".")), F.col("after"))
    return {name: F.coalesce(mark, no) for name, mark in marks.items()} | {"asks": F.col("before") == _QUERY, "given": _plain(given)}


def scoped_tokens(df: DataFrame, statement: str) -> DataFrame:
    """(stmt, pos, token, before, before3, after, after2, flat, frame, branch, clause) and ``_marks`` of all distinct statements: names, words, marks and commas.

    ``frame`` is the position of the parenthesis of the select that a token belongs to (-1 outside all), ``branch`` its number in a set operation;
    ``clause`` is the last word that began one there, not counting words inside the parentheses of an expression, ``flat`` whether the token is outside such.
    """
    text = F.col(statement)
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    # statements are dealt out while they are short; their tokens stay where they are. A fixed number keeps small texts with many tokens apart
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = df.where(text.isNotNull()).select(key.alias("stmt"), text.alias("text")).repartition(parts, "stmt").dropDuplicates(["stmt"])
    tokens = distinct.select("stmt", F.explode(_neighbours(_tokens(F.col("text")))).alias("t")).select("stmt", "t.*")
    tokens = tokens.withColumns(_marks())
    whole = Window.partitionBy("stmt").orderBy("pos")
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    opens, closes = _is("token", "("), _is("token", ")")
    # an opening and its closing parenthesis lie at the depth they enclose; behind the closing one its mark follows
    deep = tokens.withColumn("depth", F.sum(F.when(opens, 1).when(_is("token", _CLOSE), -1).otherwise(0)).over(upto))
    query = F.when(opens, F.col("asks"))
    pairs = Window.partitionBy("stmt", "depth").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    kind = deep.withColumn("query", F.last(query, True).over(pairs))
    closed = F.lag(closes & F.col("query")).over(whole)
    nested = kind.withColumn("closed", F.coalesce(closed, F.lit(False)))
    nested = nested.withColumn("level", F.sum(F.when(opens & F.col("query"), 1).when(_is("token", _CLOSE) & F.col("closed"), -1).otherwise(0)).over(upto))
    levels = Window.partitionBy("stmt", "level").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opener = F.when(opens & F.col("query"), F.struct("pos", "depth"))
    framed = nested.withColumn("opener", F.last(opener, True).over(levels)).withColumn("frame", F.coalesce("opener.pos", F.lit(-1)))
    framed = framed.withColumn("flat", F.col("depth") == F.coalesce("opener.depth", F.lit(0)))
    inside = Window.partitionBy("stmt", "frame").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    scoped = framed.withColumn("branch", F.sum(F.when(F.col("flat") & _is("token", *_SETS), 1).otherwise(0)).over(inside))
    begins = _is("token", "join", "on") | (F.col("flat") & _is("token", *_CLAUSES))
    so_far = Window.partitionBy("stmt", "frame", "branch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return scoped.withColumn("clause", F.last(F.when(begins, F.col("token")), True).over(so_far)).drop("depth", "query", "level", "opener")


def column_usage(df: DataFrame, statement: str) -> DataFrame:
    """Columns used per source table over all select statements, as sorted arrays of bounded size: (table_name, part_no, columns).

    Qualified names count wherever they stand and belong to the source with that alias or name in their own select, else in the nearest enclosing
    one. Unqualified names count in the select list of a select with a single source, and in USING for each of its tables. Columns of
    subselects and CTEs belong to the tables read inside them. Aliases, functions, literals and numbers are no columns; with several
    sources an unqualified name has no known owner and is left out. Null statements and statements without a source give nothing.
    Statements are dealt out once; what is resolved inside one stays in its row.
    """
    tokens = scoped_tokens(df, statement)
    no = F.lit(False)
    name, dotted, flat = F.col("name"), F.col("dotted"), F.col("flat")
    reading = F.coalesce(_is("clause", "from", "join"), no)
    table = reading & name & (F.col("leads") | (F.col("comma") & flat))
    sub = reading & _is("token", _CLOSE) & F.col("closed")
    view = flat & _is("clause", "with") & F.col("listed") & name
    # what follows a name, a closing parenthesis or AS in a select list is its new name; in f(unit from x) the unit is no column
    renamed = F.coalesce(F.col("named_as") | (_is("clause", "select") & flat & F.col("behind")), no)
    unit = F.col("unit") & ~flat
    column = name & ~F.col("table") & ~F.col("call") & ~renamed & ~unit & (dotted | F.coalesce(_is("clause", "select", "using"), no))
    select = Window.partitionBy("stmt", "frame", "branch")
    place = [F.col(c) for c in ("pos", "frame", "branch")]
    owner, part = _plain(F.regexp_replace("token", r"\.[^.]*$", "")).alias("owner"), _plain(F.regexp_extract("token", r"([^.]*)$", 1)).alias("part")
    entry = F.struct(*place, _plain("token").alias("token"), owner, part, "clause", "kind", "given", "low", "high", "sources")
    kind = F.when(F.col("table") & ~F.col("call"), "table").when(sub | F.col("table"), "sub").when(view, "view")
    kind = kind.when(column & dotted, "qualified").when(column, "bare")
    # tokens of no kind before the first clause do not stretch a select; they drop out behind the window, or their kind were found twice
    inside = F.when(F.col("kind").isNotNull() | F.col("clause").isNotNull(), F.col("pos"))
    marked = tokens.withColumn("table", table).withColumn("kind", kind).select(
        "*", F.min(inside).over(select).alias("low"), F.max(inside).over(select).alias("high"),
        F.sum(F.when(_is("kind", "table", "sub"), 1).otherwise(0)).over(select).alias("sources"),
    )
    texts = marked.where("kind is not null").groupBy("stmt").agg(F.collect_list(entry).alias("all"))
    of = lambda *kinds: F.filter("all", lambda e: e["kind"].isin(*kinds))
    split = texts.select(of("table", "sub").alias("sources"), F.transform(of("view"), lambda e: e["token"]).alias("views"), F.explode(of("qualified", "bare")).alias("ref"))

    bare = F.col("ref.kind") == "bare"

    def holds(source: Column) -> Column:
        called = F.coalesce(source["given"], F.when(source["kind"] == "table", source["token"]))
        last = F.when(source["given"].isNull() & (source["kind"] == "table"), source["part"])
        inside = F.col("ref.pos").between(source["low"], source["high"])
        mine = (source["frame"] == F.col("ref.frame")) & (source["branch"] == F.col("ref.branch"))
        alone = (F.col("ref.sources") == 1) | (F.col("ref.clause") == "using")
        return F.when(bare, mine & alone).otherwise(inside & F.col("ref.owner").isin(called, last))

    visible = F.filter("sources", holds)
    nearest = F.array_max(F.transform(visible, lambda source: source["low"]))
    # the nearest scope decides; there the first source of that name, or every table that USING joins
    here = F.filter(visible, lambda source: source["low"] == nearest)
    owners = F.when(bare, here).otherwise(F.slice(here, 1, 1))
    used = split.select("views", F.explode(owners).alias("source"), F.col("ref.part").alias("column_name"))
    base = (F.col("source.kind") == "table") & ~F.array_contains("views", F.col("source.token"))
    named = used.where(base & (F.col("column_name") != "*")).select(F.col("source.token").alias("table_name"), "column_name")
    # written once: the range partitioning of the lists reads it twice
    return group_members(materialize(named.distinct(), "usage"), "table_name", "column_name").withColumnRenamed("members", "columns")


def _plain(c) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))
