import contextlib
import io


def plan_text(df, mode="formatted") -> str:
    """The physical plan as printed by ``explain`` (after execution when AQE ran)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _nodes(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def run_metric(df, node_name: str, metric: str) -> list[int]:
    """Run ``df`` (adaptive execution off) and return a metric of all plan nodes whose name has ``node_name``."""
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan()
    execution.toRdd().count()
    return [node.metrics().apply(metric).value() for node in _nodes(plan) if node_name in node.nodeName()
            and node.metrics().contains(metric)]
