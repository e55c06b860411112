"""What a query did, from the numbers that Spark keeps with its plan."""

from __future__ import annotations


def _walk(node):
    yield node
    for name in ("executedPlan", "plan"):  # adaptive plans and their stages hold the plan that ran
        try:
            inner = getattr(node, name)()
        except Exception:
            continue
        if hasattr(inner, "nodeName"):
            yield from _walk(inner)
    children = node.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def total(df, node: str, metric: str) -> int:
    """Sum of a number over the nodes of a kind, after ``df`` was collected."""
    found = 0
    for part in _walk(df._jdf.queryExecution().executedPlan()):
        if str(part.nodeName()).startswith(node):
            value = part.metrics().get(metric)
            if value.isDefined():
                found += value.get().value()
    return found
