"""Which index serves a SQL query, found in the plan that Spark makes of it.

The tables of a query are stood in for by empty frames that carry their name in the metadata of their columns. Spark
resolves and optimizes the query over them, which takes no job and lists no folder. A filter that ends right above
such a frame holds for all rows that the query takes from the table there, wherever the text has it: in a derived
table, behind a join, inferred from an equality with another table, or in a subquery.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelog.functions.scalars import apply_template
from lakelog.operators.index import Pinned

TOPIC = "lakelog.topic"
_IN_SET = "spark.sql.optimizer.inSetConversionThreshold"

Asked = dict[int, tuple[int, list[str]]]  # number of an index -> how well it serves, values to look for as SQL text


def stand_in(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """An empty frame for the table ``name``. The optimizer does not know that it is empty."""
    fields = [T.StructField(f.name, f.dataType, True, {TOPIC: name}) for f in schema]
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), T.StructType(fields))


def probes(spark: SparkSession, sql: str, indexes: dict[str, list[Pinned]]) -> dict[str, tuple[Pinned, list[str]]]:
    """For each table whose every use in ``sql`` asks one index: the index, and the values to look for.

    The names of the tables have to resolve to stand-ins. Commands are not run. Served are equalities and lists of
    constants on the expression of an index or on its field, and AND and OR of them. A query that takes a table
    several times needs what any of its uses asks for; if one of them asks nothing, the table is not named.
    """
    before = spark.conf.get(_IN_SET)
    spark.conf.set(_IN_SET, str((1 << 31) - 1))  # long lists stay lists of constants
    try:
        state = spark._jsparkSession.sessionState()
        skip = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
        plan = state.executePlan(state.sqlParser().parsePlan(sql), skip).optimizedPlan()
        uses: dict[str, list[Asked]] = {}
        for leaf, condition in _leaves(plan):
            name = _topic(leaf)
            if name in indexes:
                asked = {} if condition is None else _asked(condition, _terms(spark, leaf, indexes[name]), indexes[name])
                uses.setdefault(name, []).append(asked)
    finally:
        spark.conf.set(_IN_SET, before)
    served = {}
    for name, asked in uses.items():
        both = asked[0]
        for other in asked[1:]:
            both = _either(both, other)
        if both:
            number = max(both, key=lambda i: (both[i][0], -len(both[i][1])))
            served[name] = (indexes[name][number], list(dict.fromkeys(both[number][1])))
    return served


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _leaves(plan, condition=None) -> Iterator[tuple]:
    """Leaves of a plan and its subqueries, with the condition of a filter right above."""
    for inner in _items(plan.subqueries()):
        yield from _leaves(inner)
    children = _items(plan.children())
    if not children:
        yield plan, condition
    own = plan.condition() if plan.nodeName() == "Filter" else None
    for child in children:
        yield from _leaves(child, own)


def _topic(leaf) -> str | None:
    names = {a.metadata().getString(TOPIC) for a in _items(leaf.output()) if a.metadata().contains(TOPIC)}
    return names.pop() if len(names) == 1 else None


def _terms(spark: SparkSession, leaf, indexes: list[Pinned]) -> list[tuple]:
    """(indexed expression, field) of each index over the columns of a leaf, optimized as the query is."""
    frame = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, leaf), spark)
    texts = []
    for i, index in enumerate(indexes):
        field = f"`{index.snap.props['field']}`"
        texts += [f"{apply_template(index.snap.props['template'], field)} AS __e{i}", f"{field} AS __f{i}"]
    items = _items(frame.selectExpr(*texts)._jdf.queryExecution().optimizedPlan().projectList())
    return [(items[2 * i].child(), items[2 * i + 1].child()) for i in range(len(indexes))]


def _either(a: Asked, b: Asked) -> Asked:
    """What covers both: an index has to serve either side."""
    return {i: (min(a[i][0], b[i][0]), a[i][1] + b[i][1]) for i in a.keys() & b.keys()}


def _both(a: Asked, b: Asked) -> Asked:
    """What covers rows that meet two conditions: either side will do, the narrower one for an index in both."""
    return {**a, **b, **{i: min(a[i], b[i], key=lambda x: (len(x[1]), -x[0])) for i in a.keys() & b.keys()}}


def _asked(condition, terms: list[tuple], indexes: list[Pinned]) -> Asked:
    kind = condition.nodeName()
    if kind in ("And", "Or"):
        sides = (_asked(side, terms, indexes) for side in (condition.left(), condition.right()))
        return (_both if kind == "And" else _either)(*sides)
    if kind in ("EqualTo", "EqualNullSafe"):
        left, right = condition.left(), condition.right()
        subject, constants = (right, [left]) if left.nodeName() == "Literal" else (left, [right])
    elif kind == "In":
        subject, constants = condition.value(), _items(condition.list())
    else:
        return {}
    if any(c.nodeName() != "Literal" for c in constants):
        return {}
    if kind == "EqualNullSafe" and constants[0].value() is None:
        return {}  # nulls are not in an index
    texts = [c.sql() for c in constants if c.value() is not None]
    if not texts:
        return {}
    found: Asked = {}
    for i, (expression, field) in enumerate(terms):
        if subject.semanticEquals(expression):
            found[i] = (2, texts)
        elif subject.semanticEquals(field):
            found[i] = (1, [apply_template(indexes[i].snap.props["template"], t) for t in texts])
    return found
