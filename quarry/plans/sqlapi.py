"""Read-only SQL over published views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Fixed value: rows of a result at most.
MAX_ROWS = 500
#: Functions that reach out of the query.
_REACHING = {"reflect", "java_method", "try_reflect", "input_file_name", "raise_error", "assert_true"}


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], contract: Mapping[str, list[str]]) -> None:
    """A view v_<name> for each table with exactly the contract's columns."""
    for name, columns in contract.items():
        tables[name].select(*columns).createOrReplaceTempView(f"v_{name}")


def _nodes(plan) -> list:
    """A parsed plan's own nodes, those within its expressions' subqueries and CTEs among them."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        found.append(node)
        inner = node.innerChildren()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        todo += [x for x in (inner.apply(i) for i in range(inner.size())) if hasattr(x, "children") and "plans.logical" in x.getClass().getName()]
        for e in (node.expressions().apply(i) for i in range(node.expressions().size())):
            todo += _subplans(e)
    return found


def _expressions(e) -> list:
    return [e] + [x for i in range(e.children().size()) for x in _expressions(e.children().apply(i))]


def _subplans(e) -> list:
    return [x.plan() for x in _expressions(e) if x.getClass().getSimpleName() in ("ScalarSubquery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression", "Exists", "ListQuery")]


def guarded(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """A query over published views, never a command.

    The parsed plan decides: one statement that is no command, relations that are published views (v_...) or the
    query's own CTEs, and no function that reaches out of the query. Files named by path are no views."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)  # raises on more than one statement
    nodes = _nodes(plan)
    own = {str(n.cteRelations().apply(i)._1()).lower() for n in nodes if n.nodeName() == "UnresolvedWith" for i in range(n.cteRelations().size())}
    for n in nodes:
        kind = n.getClass().getName()
        if "Command" in kind or n.nodeName().startswith(("Insert", "Create", "Drop", "Alter", "Set", "Cache", "Delete", "Update", "Merge", "Replace", "Truncate")):
            raise ValueError("only a query is allowed")
        if n.nodeName() == "UnresolvedRelation":
            name = [str(n.multipartIdentifier().apply(i)) for i in range(n.multipartIdentifier().size())]
            if len(name) > 1 or not (name[0].lower().startswith("v_") or name[0].lower() in own):
                raise ValueError(f"no published view: {'.'.join(name)}")
        for i in range(n.expressions().size()):
            for e in _expressions(n.expressions().apply(i)):
                if e.getClass().getSimpleName() == "UnresolvedFunction" and str(e.nameParts().last()).lower() in _REACHING:
                    raise ValueError("a function that is not allowed")
    return spark.sql(text, args=dict(args or {}))


def query(spark: SparkSession, text: str, max_rows: int = 50, args: Mapping[str, object] | None = None) -> dict:
    """At most max_rows rows (500 at most) and whether there are more."""
    n = max(1, min(max_rows, MAX_ROWS))
    rows = guarded(spark, text, args).limit(n + 1).collect()
    return {"rows": [r.asDict(recursive=True) for r in rows[:n]], "truncated": len(rows) > n}


def lint_bump(before: Mapping, after: Mapping) -> list[str]:
    """What a contract change needs. A contract is {"version": "x.y", "views": {view: {column: type}}, "capabilities": [...]}.

    Anything removed or retyped asks for a greater first number, anything added for a greater version."""

    def facts(spec: Mapping) -> dict[tuple, str]:
        held = {("view", v): "" for v in spec["views"]} | {("column", f"{v}.{c}"): t for v, cols in spec["views"].items() for c, t in cols.items()}
        return held | {("capability", c): "" for c in spec.get("capabilities", ())}

    old, new = facts(before), facts(after)
    gone = sorted(" ".join(k) for k in old if k not in new and not (k[0] == "column" and ("view", k[1].split(".")[0]) not in new))
    retyped = sorted(f"{k[1]} {old[k]} to {new[k]}" for k in old.keys() & new.keys() if old[k] != new[k])
    added = sorted(" ".join(k) for k in new.keys() - old.keys())
    was, now = (tuple(int(x) for x in spec["version"].split(".")[:2]) for spec in (before, after))
    if (gone or retyped) and now[0] <= was[0]:
        return ["major version: " + "; ".join(["removed " + x for x in gone] + ["retyped " + x for x in retyped])]
    if added and not (gone or retyped) and now <= was:
        return ["minor version: added " + "; ".join(added)]
    return []
