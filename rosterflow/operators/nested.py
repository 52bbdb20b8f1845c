"""Nested semi-structured records to flat tables with parent links, by higher-order SQL projection.

A generation is the array of one level's containers, each with its path, the path of the object around it and its
members or elements. Nested ``transform`` calls make the next generation out of it, attaching the ancestor's
path and the index or name; ``flatten`` joins what the parents gave. A pass unrolls GENERATIONS levels in one
projection. What lies deeper comes out as unexpanded containers of the last generation, and the next pass starts
from those, until none are left. One ``inline`` for each target table emits its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.runtime import written

GENERATIONS = 14
_END = "rosterflow-end"  # closes a text so that anything after its value makes it invalid
_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


@contextmanager
def _last_of_duplicates(spark: SparkSession) -> Iterator[None]:
    """Of a member named twice the last counts, in what is planned and executed meanwhile; the session's setting stays as it was."""
    before = spark.conf.get(_DUPLICATES)
    spark.conf.set(_DUPLICATES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DUPLICATES, before)


def _value(text: str) -> str:
    """Variant of the JSON ``text``, null if it isn't valid as a whole."""
    both = f"try_parse_json(concat('[', {text}, ',\"{_END}\"]'))"
    parts = f"try_variant_get({both}, '$', 'array<variant>')"
    return f"(transform(array({parts}), p -> if(size(p) = 2 and try_variant_get(p[1], '$', 'string') = '{_END}', p[0], null))[0])"


def _node(n: str, value: str) -> str:
    """A node of path and surroundings of ``n``, with the members or elements of ``value`` if it is a container."""
    return f"struct({n}.path as path, {n}.above as above, {value} as v, try_variant_get({value}, '$', 'map<string,variant>') as m, try_variant_get({value}, '$', 'array<variant>') as a)"


_OPENS = "substr(ltrim(' \\t\\n\\r', {}), 1, 1) in ('{{', '[')"


def _read(raw: str) -> str:
    """Containers among (path, above, v); a string that holds the text of an object or array counts as it, scalars end here."""
    text = "try_variant_get(n.v, '$', 'string')"
    inner = f"transform(array({_value(text)}), p -> {_node('n', 'p')})[0]"
    kept = f"if(n.m is not null or n.a is not null, n, if({_OPENS.format(text)}, {inner}, null))"
    seen = f"transform({raw}, n -> {_node('n', 'n.v')})"
    return f"filter(transform({seen}, n -> {kept}), n -> n.m is not null or n.a is not null)"


def _children(n: str) -> str:
    """The next generation of one node: members of an object, elements of an array."""
    members = f"transform(map_entries({n}.m), e -> struct(concat({n}.path, '.', e.key) as path, {n}.path as above, e.value as v))"
    elements = f"transform({n}.a, (e, i) -> struct(concat({n}.path, '[', i, ']') as path, {n}.above as above, e as v))"
    return f"if({n}.m is not null, {members}, {elements})"


_TEXT = "try_variant_get(x, '$', 'string')"
# members that are neither containers nor texts of containers, as text; a null stays a null
_SCALAR = f"try_variant_get(x, '$', 'map<string,variant>') is null and try_variant_get(x, '$', 'array<variant>') is null and not coalesce({_OPENS.format(_TEXT)} and {_value(_TEXT)} is not null, false)"
_MEMBERS = f"transform_values(map_filter(n.m, (k, x) -> {_SCALAR}), (k, x) -> {_TEXT})"


def _pass(df: DataFrame, generations: int, values: bool) -> DataFrame:
    """From (record_key, g0) the nodes of the next generations: objects, and the containers left unexpanded (``rest``)."""
    for k in range(generations):
        df = df.withColumn(f"g{k + 1}", F.expr(_read(f"flatten(transform(g{k}, n -> {_children('n')}))")))
    held = _MEMBERS if values else "cast(null as map<string,string>)"
    objects = ", ".join(f"transform(filter(g{k}, n -> n.m is not null), n -> struct(n.path as node_path, n.above as parent_path, {held} as members, cast(null as string) as rest))" for k in range(1, generations + 1))
    rest = f"transform(g{generations}, n -> struct(n.path as node_path, n.above as parent_path, cast(null as map<string,string>) as members, to_json(n.v) as rest))"
    return df.select("record_key", F.expr(f"concat({objects}, {rest})").alias("nodes"))


def nested_nodes(df: DataFrame, record_key: str, field: str, generations: int = GENERATIONS, values: bool = True) -> DataFrame:
    """(record_key, nodes): the objects below the root of ``field``, as node_path, parent_path and members (scalars as text).

    ``df``'s other columns are not read. Fields that are null, blank or not valid JSON as a whole give
    nothing; a scalar root gives nothing; of a member named twice the last counts; objects may be empty;
    re-sent rows count once; a null key is kept. ``node_path`` is ``$``, ``.name``, ``[i]``;
    ``parent_path`` is that of the nearest object around, or ``$``. Any depth is followed. ``members`` is null unless ``values``.
    """
    with _last_of_duplicates(df.sparkSession):
        return _all_passes(df, record_key, field, generations, values)


def _all_passes(df: DataFrame, record_key: str, field: str, generations: int, values: bool) -> DataFrame:
    rows = df.select(F.col(f"`{record_key}`").alias("record_key"), F.col(f"`{field}`").cast("string").alias("text")).where("ltrim(' \\t\\n\\r', text) rlike '^[\\\\[{\"]'").dropDuplicates()
    start = f"transform(array({_value('text')}), v -> struct('$' as path, '$' as above, v as v))"
    now = rows.select("record_key", F.expr(_read(start)).alias("g0"))
    done: DataFrame | None = None
    while True:
        flat = written(_pass(now, generations, values), "nested")
        found = flat.select("record_key", F.expr("transform(filter(nodes, n -> n.rest is null), n -> struct(n.node_path, n.parent_path, n.members))").alias("nodes"))
        done = found if done is None else done.unionByName(found)
        rest = flat.select("record_key", F.expr("inline(filter(nodes, n -> n.rest is not null))"))
        if rest.isEmpty():
            return done
        # a container at the limit: an array keeps the object around it, an object is around its members
        now = rest.select("record_key", F.expr(_read("array(struct(node_path as path, parent_path as above, parse_json(rest) as v))")).alias("g0"))


def nested_objects(df: DataFrame, record_key: str, field: str, generations: int = GENERATIONS) -> DataFrame:
    """record_key, node_path, parent_path of every JSON object below the root of ``field``; see ``nested_nodes``."""
    return nested_nodes(df, record_key, field, generations, values=False).select("record_key", F.expr("inline(nodes)")).drop("members")


def members_table(nodes: DataFrame) -> DataFrame:
    """record_key, node_path, member, value: all scalar members of all inner objects."""
    flat = "flatten(transform(nodes, n -> transform(map_entries(n.members), e -> struct(n.node_path as node_path, e.key as member, e.value as value))))"
    return nodes.select("record_key", F.expr(f"inline({flat})"))


def flat_table(nodes: DataFrame, names: Sequence[str], columns: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """The target table of the objects that are held under a member of one of ``names``, alone or in an array.

    record_key, node_path, parent_path, ordinal (the index in an array, else null) and ``columns``: name -> (type, members
    to try in order). What doesn't cast is null.
    """
    name = "regexp_extract(regexp_replace(n.node_path, '(\\\\[[0-9]+\\\\])+$', ''), '[.]([^.]*)$', 1)"
    wanted = ", ".join("'" + x.replace("'", "\\'") + "'" for x in names)
    cells = ", ".join(f"try_cast(coalesce({', '.join(f'''n.members['{m}']''' for m in tries)}) as {kind}) as `{c}`" for c, (kind, tries) in columns.items())
    index = "try_cast(regexp_extract(n.node_path, '\\\\[([0-9]+)\\\\]$', 1) as int)"
    rows = f"transform(filter(nodes, n -> {name} in ({wanted})), n -> struct(n.node_path as node_path, n.parent_path as parent_path, {index} as ordinal, {cells}))"
    return nodes.select("record_key", F.expr(f"inline({rows})"))
