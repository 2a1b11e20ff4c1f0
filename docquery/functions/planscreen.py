"""What a statement may do, decided on its parsed plan instead of its text."""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import ParseException
from pyspark.sql import SparkSession

NOT_A_VIEW = "only the registered views can be read"
NO_VIEW = "TABLE_OR_VIEW_NOT_FOUND"
NOT_PLAIN = "only plain SELECT queries are allowed"
NO_FUNCTION = "function is not allowed: "
NO_EXPRESSION = "expression is not allowed: "

# Plans that read nothing by themselves and run no foreign code.
_PLAIN = set(
    """Project Filter Aggregate Sort GlobalLimit LocalLimit Offset SubqueryAlias Join LateralJoin Union Distinct
    Except Intersect UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedHaving WithWindowDefinition
    OneRowRelation UnresolvedWith UnresolvedInlineTable Pivot Unpivot UnresolvedOrderBy
    UnresolvedTableSubqueryColumnAliases""".split()
)
# Expressions that a parser leaves open and that stand for columns, stars, names and calls.
_OPEN = set(
    """UnresolvedAttribute UnresolvedAlias UnresolvedStar UnresolvedStarExceptOrReplace UnresolvedFunction
    UnresolvedExtractValue UnresolvedRegex UnresolvedNamedLambdaVariable UnresolvedWindowExpression UnresolvedOrdinal
    MultiAlias""".split()
)
_RESOLVED = "org.apache.spark.sql.catalyst.expressions."
_FOREIGN = {"reflect", "java_method", "try_reflect"}
_FOREIGN_KINDS = {"CallMethodViaReflection", "ScalaUDF", "PythonUDF", "Invoke", "StaticInvoke"}


def _items(seq) -> Iterator:
    for i in range(seq.size()):
        yield seq.apply(i)


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


class _Screen:
    def __init__(self, spark: SparkSession):
        self.catalog = spark._jsparkSession.sessionState().catalog()
        jvm = spark._jvm.org.apache.spark.sql.catalyst
        self.builtin = jvm.analysis.FunctionRegistry.builtin()
        self.identifier = jvm.FunctionIdentifier
        self.exact = spark.conf.get("spark.sql.caseSensitive") == "true"

    def name(self, text: str) -> str:
        return text if self.exact else text.lower()

    def error(self, plan) -> str | None:
        """The first thing that is wrong in a plan. Each plan is seen with the names its own `WITH` clauses give it."""
        todo = [(plan, frozenset())]
        while todo:
            node, names = todo.pop()
            kind = _kind(node)
            if kind not in _PLAIN:
                return NOT_PLAIN
            if kind == "UnresolvedRelation" and (broken := self.relation_error(node, names)):
                return broken
            if kind == "UnresolvedWith":
                # A definition sees those before it; the names end with the statement they stand in front of.
                for pair in _items(node.cteRelations()):
                    todo.append((pair._2(), names))
                    names = names | {self.name(pair._1())}
            todo += [(child, names) for child in _items(node.children())]
            if kind == "LateralJoin":
                todo.append((node.right().plan(), names))
            for inner in _items(node.expressions()):
                broken, plans = self.expression(inner)
                if broken:
                    return broken
                todo += [(p, names) for p in plans]
        return None

    def relation_error(self, node, names: frozenset[str]) -> str | None:
        parts = list(_items(node.multipartIdentifier()))
        if len(parts) > 1:
            return NOT_A_VIEW
        known = self.name(parts[0]) in names or not self.catalog.getTempView(parts[0]).isEmpty()
        return None if known else NO_VIEW

    def expression(self, whole) -> tuple[str | None, list]:
        """What is wrong in an expression, and the plans of its subqueries."""
        todo, plans = [whole], []
        while todo:
            node = todo.pop()
            kind = _kind(node)
            if kind == "UnresolvedFunction":
                name = [part.lower() for part in _items(node.nameParts())]
                known = len(name) == 1 and self.builtin.functionExists(self.identifier(name[0]))
                if not known or name[0] in _FOREIGN:
                    return NO_FUNCTION + ".".join(name), []
            elif kind not in _OPEN:
                ready = node.getClass().getName().startswith(_RESOLVED) and not kind.startswith("Unresolved")
                if not ready or kind in _FOREIGN_KINDS:
                    return NO_EXPRESSION + kind, []
            if hasattr(node, "plan") and kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
                plans.append(node.plan())
            todo += _items(node.children())
        return None, plans


def plan_error(spark: SparkSession, sql: str) -> str | None:
    """Why the statement must not run, or null. A text that doesn't parse passes: running it says why.

    Leaves must be temporary views, or names that a `WITH` around them defines; no paths, other
    catalogs, table functions, scripts, reflection, computed names or user functions. `LATERAL VIEW`,
    `TABLESAMPLE` and `range()` are not among the plain plans and are refused with them.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException:
        return None
    return _Screen(spark).error(plan)
