"""Workflows: jobs of pipelines of nodes, wired by dependencies.

Nodes build lazy DataFrames; nothing runs before a sink. A node's class is
looked up in a registry by the name that the XML gives, never imported.
Properties: command line `node.key`, then command line `key`, then the node's
own, then the workflow's.
"""

from __future__ import annotations

import graphlib
import typing
import xml.etree.ElementTree as ET
from collections import ChainMap
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame, SparkSession


class State(Enum):
    CREATED = "created"
    INIT = "init"
    READY = "ready"
    EXECUTING = "executing"
    COMPLETED = "completed"
    TERMINATED = "terminated"
    FAILED = "failed"


class FlowError(Exception):
    pass


class DependencyError(FlowError):
    pass


class Terminated(Exception):
    """Raised by a node to end its pipeline early and well."""


REGISTRY: dict[str, type[Node]] = {}


def node(name: str):
    def add(cls):
        REGISTRY[name] = cls
        return cls

    return add


class Node:
    """One step. Subclasses define run(inputs…): without inputs a source, with
    one a step, with several named ones a join or union."""

    takes: tuple[int, int] = (0, 1)

    def __init__(self, id: str, properties: dict[str, str] | None = None):
        self.id, self.own = id, dict(properties or {})
        self.inputs: dict[str, str] = {}
        self.state, self.result, self.error = State.CREATED, None, None
        self.all: ChainMap = ChainMap(self.own)

    def bind(self, spark: SparkSession, shared: dict, cli: dict) -> None:
        mine = {k[len(self.id) + 1 :]: v for k, v in cli.items() if k.startswith(f"{self.id}.")}
        self.spark, self.all, self.state = spark, ChainMap(mine, cli, self.own, shared), State.INIT

    def get(self, key: str, default=None, kind=str):
        if key not in self.all:
            if default is None:
                raise FlowError(f"node {self.id} needs the property {key}")
            return default
        return kind(self.all[key])

    def names(self, key: str, default: str | None = None) -> list[str]:
        return [x.strip() for x in self.get(key, default).replace(";", ",").split(",") if x.strip()]

    def coalesced(self, df: DataFrame) -> DataFrame:
        n = self.get("coalescePartition", 0, int)
        return df.coalesce(n) if n > 0 else df

    def run(self, **inputs):
        raise NotImplementedError

    @classmethod
    def returns(cls):
        return typing.get_type_hints(cls.run).get("return", DataFrame)

    @classmethod
    def accepts(cls):
        hints = {k: v for k, v in typing.get_type_hints(cls.run).items() if k != "return"}
        return next(iter(hints.values()), DataFrame)


@dataclass
class Pipeline:
    name: str
    nodes: dict[str, Node]
    properties: dict[str, str] = field(default_factory=dict)

    def check(self) -> list[str]:
        """The order to run in; errors for cycles, unknown nodes, numbers and types of inputs."""
        for n in self.nodes.values():
            for dep in n.inputs.values():
                if dep not in self.nodes:
                    raise DependencyError(f"{n.id} depends on {dep}, which isn't there")
                if not issubclass(self.nodes[dep].returns(), n.accepts()):
                    raise FlowError(f"{dep} gives {self.nodes[dep].returns().__name__}, {n.id} takes {n.accepts().__name__}")
            least, most = n.takes
            if not least <= len(n.inputs) <= most:
                raise FlowError(f"{n.id} takes {least} to {most} inputs, not {len(n.inputs)}")
        try:
            return list(graphlib.TopologicalSorter({n.id: n.inputs.values() for n in self.nodes.values()}).static_order())
        except graphlib.CycleError as e:
            raise DependencyError(f"nodes depend on each other: {e.args[1]}") from e

    def execute(self, spark: SparkSession, cli: dict | None = None) -> dict:
        order = self.check()
        for n in self.nodes.values():
            n.bind(spark, self.properties, cli or {})
        done: dict = {}
        for i in order:
            n = self.nodes[i]
            n.state = State.EXECUTING
            try:
                n.result = done[i] = n.run(**{k: done[v] for k, v in n.inputs.items()})
            except Terminated:
                n.state = State.TERMINATED
                break
            except Exception as e:
                n.state, n.error = State.FAILED, e
                raise
            n.state = State.COMPLETED
        return done


@dataclass
class Job:
    name: str
    pipelines: list[Pipeline]
    authors: str = ""
    config: dict[str, str] = field(default_factory=dict)


def _properties(e: ET.Element | None) -> dict[str, str]:
    return {} if e is None else {p.attrib["key"]: p.attrib.get("value", p.text or "") for p in e.findall("property")}


def build_job(xml: str) -> Job:
    """job(@name) > config, pipeline(@name) > properties, node(@id, @processor) > properties, dependency > node(@id, @input)."""
    root = ET.fromstring(xml)
    if not root.attrib.get("name"):
        raise FlowError("a job needs a name")
    config = {e.attrib["key"]: e.attrib.get("value", "") for e in root.findall("config/*") if "key" in e.attrib}
    pipelines = []
    for p in root.findall("pipeline"):
        nodes: dict[str, Node] = {}
        for e in p.findall("node"):
            kind = e.attrib.get("processor", "")
            if kind not in REGISTRY:
                raise FlowError(f"unknown processor {kind!r}; there are {sorted(REGISTRY)}")
            if e.attrib["id"] in nodes:
                raise FlowError(f"two nodes have the id {e.attrib['id']}")
            n = REGISTRY[kind](e.attrib["id"], _properties(e.find("properties")))
            for d in e.findall("dependency/node"):
                n.inputs[d.attrib.get("input", "df")] = d.attrib["id"]
            nodes[n.id] = n
        pipelines.append(Pipeline(p.attrib.get("name", root.attrib["name"]), nodes, {**config, **_properties(p.find("properties"))}))
    for p in pipelines:
        p.check()
    return Job(root.attrib["name"], pipelines, root.attrib.get("authors", ""), config)


def parse_arguments(args: list[str]) -> dict[str, str]:
    """key=value; anything else is an error."""
    bad = [a for a in args if "=" not in a]
    if bad:
        raise FlowError(f"not key=value: {bad}")
    return dict(a.split("=", 1) for a in args)


def run_job(spark: SparkSession, make: typing.Callable[[], Job], arguments: dict[str, str], parallelism: int = 2) -> dict[str, dict]:
    """All pipelines for the instant `dataTime` and the regression-1 before it;
    all must succeed. Pipelines run as threads on one session, each in a
    scheduler pool of its own."""
    from ..functions.times import backfill

    times = backfill(arguments["dataTime"], int(arguments.get("regression", 1))) if "dataTime" in arguments else [""]
    work = []
    for t in times:
        for p in make().pipelines:
            work.append((f"{p.name}@{t}" if t else p.name, p, {**arguments, **({"dataTime": t, "beginDataTime": times[-1]} if t else {})}))

    def one(item):
        name, pipeline, args = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return pipeline.execute(spark, args)

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        futures = [(w[0], pool.submit(one, w)) for w in work]
        results, errors = {}, {}
        for name, f in futures:
            try:
                results[name] = f.result()
            except Exception as e:
                errors[name] = e
    if errors:
        raise FlowError(f"failed: {errors}") from next(iter(errors.values()))
    return results
