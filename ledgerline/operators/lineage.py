"""Lineage: table edges, and the origin of each column by the analysed plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

INGEST_ADDED = {"_cob_date", "_ingest_ts", "_source_file", "_file_version", "_row_number", "_batch_id", "_delivery_id", "_received_at", "_schema_version", "_source_system", "_extra_columns"}
BUILD_METADATA = {"source_batch_id", "dbt_invocation_id", "nessie_ref", "dbt_updated_at"}


def edges(models: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(parent, child) of tables from each model's inputs."""
    return sorted((p, c) for c, parents in models.items() for p in parents)


def upstream(models: dict[str, list[str]], target: str) -> set[str]:
    """All tables a table depends on."""
    seen, todo = set(), [target]
    while todo:
        for p in models.get(todo.pop(), ()):
            if p not in seen:
                seen.add(p)
                todo.append(p)
    return seen


def feeds_behind(models: dict[str, list[str]], target: str, prefix: str = "raw.") -> set[str]:
    return {t.removeprefix(prefix) for t in upstream(models, target) if t.startswith(prefix)}


def _each(sequence):
    it = sequence.iterator()
    while it.hasNext():
        yield it.next()


def _inside(jvm, expression):
    """All nodes of an expression tree, the expression first; those of plans inside it too."""
    yield expression
    for child in _each(expression.children()):
        yield from _inside(jvm, child)


def classify_columns(df: DataFrame) -> dict[str, tuple[str, list[str]]]:
    """Column -> (kind, source columns): sourced, row_aggregate, windowed, generated,
    build_metadata, literal, ingest_added or unresolved.

    Walks the analysed logical plan and tells what is made by the types of Catalyst's nodes, not by
    their text: aggregate functions, windows, generators, plans inside expressions (subqueries,
    whose outputs count as what the expression uses), and set operations, whose columns come from
    all their branches. Attributes are followed by their ids down to the relations' columns."""
    jvm = df.sparkSession._jvm
    java = jvm.java.lang.Class.forName
    prefix = "org.apache.spark.sql.catalyst"
    kinds = {k: java(f"{prefix}.{n}") for k, n in {
        "aggregate": "expressions.aggregate.AggregateFunction", "window": "expressions.WindowExpression", "alias": "expressions.Alias", "attribute": "expressions.AttributeReference",
        "inner": "plans.logical.LogicalPlan", "planned": "expressions.PlanExpression", "generate": "plans.logical.Generate", "union": "plans.logical.Union", "set": "plans.logical.SetOperation",
    }.items()}
    is_a = lambda kind, x: kinds[kind].isInstance(x)
    made: dict[int, tuple[set[int], set[str]]] = {}  # id -> (ids it uses, what it is made by)
    leaves: dict[int, str] = {}

    def seen(i: int, uses: set[int], marks: set[str]) -> None:
        old = made.get(i, (set(), set()))
        made[i] = (old[0] | uses, old[1] | marks)

    def told(expression) -> tuple[set[int], set[str]]:
        uses, marks = set(), set()
        for x in _inside(jvm, expression):
            if is_a("attribute", x):
                uses.add(x.exprId().id())
            elif is_a("window", x):
                marks.add("windowed")
            elif is_a("aggregate", x):
                marks.add("row_aggregate")
            if is_a("planned", x):
                walk(x.plan())
                uses |= {a.exprId().id() for a in _each(x.plan().output())}
        # an aggregate function over a window makes no row less
        return uses, marks - {"row_aggregate"} if "windowed" in marks else marks

    def walk(node) -> None:
        children = list(_each(node.children()))
        if not children:
            for a in _each(node.output()):
                leaves[a.exprId().id()] = a.name()
        for e in _each(node.expressions()):
            for x in _inside(jvm, e):
                if is_a("alias", x):
                    seen(x.exprId().id(), *told(x.child()))
                elif is_a("planned", x):
                    walk(x.plan())
        if is_a("generate", node):
            uses, _ = told(node.generator())
            for a in _each(node.generatorOutput()):
                seen(a.exprId().id(), uses, {"generated"})
        if is_a("union", node) or is_a("set", node):
            columns = [[a.exprId().id() for a in _each(c.output())] for c in children]
            for n, a in enumerate(_each(node.output())):
                seen(a.exprId().id(), {c[n] for c in columns} - {a.exprId().id()}, set())
                for c in columns[1:]:  # the output may keep the first branch's ids
                    seen(columns[0][n], {c[n]}, set())
        for c in children:
            walk(c)

    plan = df._jdf.queryExecution().analyzed()
    walk(plan)

    def trace(i: int, path: frozenset[int]) -> tuple[set[str], set[str]]:
        names, marks = ({leaves[i]}, set()) if i in leaves else (set(), set())
        if i in made and i not in path:
            uses, own = made[i]
            marks |= own
            for u in uses:
                n, m = trace(u, path | {i})
                names |= n
                marks |= m
        return names, marks

    out = {}
    for a in _each(plan.output()):
        name, i = a.name(), a.exprId().id()
        names, marks = trace(i, frozenset())
        if name in BUILD_METADATA:
            kind = "build_metadata"
        elif names and names <= INGEST_ADDED:
            kind = "ingest_added"
        else:
            kind = next((k for k in ("row_aggregate", "windowed", "generated") if k in marks), None)
            kind = kind or ("sourced" if names else "literal" if i in made else "unresolved")
        out[name] = (kind, sorted(names))
    return out
