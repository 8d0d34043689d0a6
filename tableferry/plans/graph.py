"""Jobs of several sources, steps and sinks that are linked by name.

A graph is only a description. When it runs, names are resolved in topological order, so
that Spark plans everything between a source and a sink as one query; a result that
several others use is written to the shared folder once and read from there. Sinks that
are done stay done: after a failure the same run goes on with the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tableferry.session import scratch_dir

Sink = Callable[[DataFrame], DataFrame | None]


@dataclass(frozen=True)
class _Node:
    kind: str
    make: Callable | str
    inputs: tuple[str, ...] = ()
    after: tuple[str, ...] = ()
    again: bool = False


class SinkFailed(RuntimeError):
    """Some sinks failed: ``failed`` has their errors by name, ``done`` the names of those that ended."""

    def __init__(self, failed: dict[str, BaseException], done: Iterable[str]):
        self.failed, self.done = failed, sorted(done)
        super().__init__(f"failed: {', '.join(sorted(failed))}; done: {', '.join(self.done) or 'none'}")


@dataclass
class JobGraph:
    """Sources, steps and sinks by name; a name is given once, and may be used before it is given."""

    nodes: dict[str, _Node] = field(default_factory=dict)

    def _add(self, name: str, node: _Node) -> JobGraph:
        if not name.isidentifier():
            raise ValueError(f"{name!r} cannot be the name of a view")
        if name in self.nodes:
            raise ValueError(f"{name} is there already")
        self.nodes[name] = node
        return self

    def source(self, name: str, read: Callable[[SparkSession], DataFrame], again: bool = False) -> JobGraph:
        """Rows from outside. Several users share one stored copy, unless it may be read ``again`` by each."""
        return self._add(name, _Node("source", read, again=again))

    def step(self, name: str, inputs: str | Sequence[str], make: Callable[..., DataFrame] | str, again: bool = False) -> JobGraph:
        """A function of the inputs' DataFrames in their order, or SQL text that knows the inputs as views."""
        return self._add(name, _Node("step", make, _names(inputs), again=again))

    def sink(self, name: str, source: str, write: Sink, after: str | Sequence[str] = ()) -> JobGraph:
        """Publishes one result, once the sinks it comes ``after`` are done."""
        return self._add(name, _Node("sink", write, (source,), _names(after)))

    def order(self) -> list[str]:
        """Names that sinks need, each behind what it needs.

        Unknown names, sinks used as inputs and cycles are errors; a cycle is named in full.
        """
        out: list[str] = []
        done: set[str] = set()

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError(f"the graph has a cycle: {' -> '.join([*path[path.index(name):], name])}")
            if name in done:
                return
            if name not in self.nodes:
                raise ValueError(f"{path[-1]} needs {name}, which is not there")
            node = self.nodes[name]
            for other in node.inputs:
                if other in self.nodes and self.nodes[other].kind == "sink":
                    raise ValueError(f"{name} cannot read the sink {other}")
            for other in node.after:
                if other in self.nodes and self.nodes[other].kind != "sink":
                    raise ValueError(f"{name} can only come after sinks, and {other} is a {self.nodes[other].kind}")
            for other in (*node.inputs, *node.after):
                visit(other, (*path, name))
            done.add(name)
            out.append(name)

        for name, node in self.nodes.items():
            if node.kind == "sink":
                visit(name, ())
        return out

    def users(self) -> dict[str, list[str]]:
        """Who reads each name, of those that a sink needs."""
        needed = self.order()
        return {name: [n for n in needed if name in self.nodes[n].inputs] for name in needed}

    def start(self, spark: SparkSession) -> GraphRun:
        """A run of this graph that has done nothing yet."""
        return GraphRun(self, spark)

    def run(self, spark: SparkSession, at_once: int = 1) -> dict[str, DataFrame | None]:
        """What each sink returned, by name."""
        return self.start(spark).go(at_once)


def _names(given: str | Sequence[str]) -> tuple[str, ...]:
    return (given,) if isinstance(given, str) else tuple(given)


@contextmanager
def _views(spark: SparkSession, frames: dict[str, DataFrame]):
    """Names the frames for SQL text; views of the same names come back afterwards."""
    before = {n: spark.table(n) for n in frames if any(v.isTemporary for v in spark.catalog.listTables(pattern=n) if v.name == n)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


class GraphRun:
    """One run: what was staged, and which sinks are done."""

    def __init__(self, graph: JobGraph, spark: SparkSession):
        self.graph, self.spark = graph, spark
        self.order, self.users = graph.order(), graph.users()
        self.frames: dict[str, DataFrame] = {}
        self.results: dict[str, DataFrame | None] = {}

    def frame(self, name: str) -> DataFrame:
        """The rows under a name; what several others use is computed now, anything else by those who use it."""
        if name not in self.frames:
            node = self.graph.nodes[name]
            if node.kind == "sink":
                raise ValueError(f"{name} is a sink")
            given = {n: self.frame(n) for n in node.inputs}
            if node.kind == "source":
                df = node.make(self.spark)
            elif isinstance(node.make, str):
                # Views are resolved while the text is analysed, here.
                with _views(self.spark, given):
                    df = self.spark.sql(node.make)
            else:
                df = node.make(*given.values())
            if len(self.users.get(name, ())) > 1 and not node.again:
                df = self._staged(df, name)
            self.frames[name] = df
        return self.frames[name]

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def go(self, at_once: int = 1) -> dict[str, DataFrame | None]:
        """Run the sinks that are not done yet, up to ``at_once`` at a time; what each returned, by name.

        A sink whose predecessor failed is not begun. If any failed, the others end first and
        :class:`SinkFailed` is raised; calling this again goes on from there and reads what was staged.
        """
        if at_once < 1:
            raise ValueError("at_once must be at least 1")
        sinks = [n for n in self.order if self.graph.nodes[n].kind == "sink"]
        failed: dict[str, BaseException] = {}
        with ThreadPoolExecutor(at_once) as pool:
            while ready := [
                n for n in sinks
                if n not in self.results and n not in failed and all(a in self.results for a in self.graph.nodes[n].after)
            ]:
                begun = []
                for name in ready:
                    try:
                        df = self.frame(self.graph.nodes[name].inputs[0])
                    except Exception as error:
                        failed[name] = error
                        continue
                    begun.append((name, pool.submit(inheritable_thread_target(self.spark)(self.graph.nodes[name].make), df)))
                for name, future in begun:
                    try:
                        self.results[name] = future.result()
                    except Exception as error:
                        failed[name] = error
        if failed:
            raise SinkFailed(failed, self.results) from next(iter(failed.values()))
        return dict(self.results)
