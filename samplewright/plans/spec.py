"""Declared jobs: a wide table of features, read from XML or a dict."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

from ..operators.encode import normal_crosses

# Fixed values of the configuration's attributes.
TASKS = ("train", "val", "test", "predict")
FEATURE_TYPES = ("numeric", "category", "multi")
METHODS = ("equi_freq", "equi_val")
OPERATORS = ("dummy", "identity")


def _yes(text: str | None) -> bool:
    return (text or "").strip().lower() in ("1", "true", "yes")


@dataclass
class FeatureSpec:
    name: str
    value_field: str
    kind: str = "numeric"
    dtype: str = "string"
    encode: bool = False
    discretize: bool = False
    method: str = "equi_freq"
    bins: int = 10
    top: int = 0
    operator: str = "dummy"
    score_field: str = ""

    def __post_init__(self):
        for value, known in ((self.kind, FEATURE_TYPES), (self.method, METHODS), (self.operator, OPERATORS)):
            if value not in known:
                raise ValueError(f"feature {self.name}: {value!r} is none of {known}")


@dataclass
class TableSpec:
    name: str
    source: str
    time: str
    features: list[FeatureSpec]
    id_field: str = ""
    join_field: str = ""
    from_id: str = ""
    to_id: str = ""

    def __post_init__(self):
        if not self.from_id and not self.to_id:
            self.from_id = self.to_id = self.id_field


@dataclass
class WideSpec:
    task: str
    data_type: str
    label: str
    label_rate: int
    split: dict[str, float]
    root: str
    formats: list[str]
    action: str
    ids: list[str]
    context: list[FeatureSpec]
    tables: list[TableSpec]
    crosses: dict[str, list[str]] = field(default_factory=dict)
    id_features: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)

    def feature_index(self) -> dict[str, int]:
        """All feature names in order, numbered from 0."""
        names = {f.name for f in self.context} | {f.name for t in self.tables for f in t.features}
        return {n: i for i, n in enumerate(sorted(n for n in names if n.strip()))}


def _feature(e: ET.Element) -> FeatureSpec:
    get = e.attrib.get
    name = get("feature_name", "")
    return FeatureSpec(name, get("value_field", name), get("feature_type") or "numeric", get("type") or "string", _yes(get("isencode")), _yes(get("isdiscretize")), get("discretize") or "equi_freq", int(get("discretize_argv") or 10), int(get("top") or 0), get("operator") or "dummy", get("score_field", ""))


def _name(root: ET.Element, path: str, default: str = "") -> str:
    e = root.find(path)
    return default if e is None else e.attrib.get("name", default)


def read_wide_spec(xml: str) -> WideSpec:
    root = ET.fromstring(xml)
    task, rate = _name(root, "task_type", "train"), _name(root, "sample/labelrate")
    if task not in TASKS:
        raise ValueError(f"task_type {task!r} is none of {TASKS}")
    if not rate:
        raise ValueError("sample/labelrate is required")
    tables = []
    for e in root.findall("feature_collect/feature_data"):
        ids = e.find("id_conf")
        get = (ids.attrib if ids is not None else {}).get
        tables.append(TableSpec(e.attrib.get("norm_name", ""), (e.findtext("input") or "").strip(), e.attrib.get("time", "last"), [_feature(f) for f in e.findall("features/feature")], get("id_field", ""), get("join_field", ""), get("from_id", ""), get("to_id", "")))
    crosses, id_features = [], []
    for e in root.findall("gen_feature/features"):
        if e.attrib.get("name") == "comb_features":
            crosses += [(f.attrib["name"], f.attrib.get("dependencies", "").replace("|", ",").replace(";", ",").split(",")) for f in e.iter("feature")]
        elif e.attrib.get("name") == "id_features":
            id_features += [f.attrib["name"] for f in e.iter("feature")]
    formats = [k for k, tag in (("tfrecord", "is_TFRecord"), ("libsvm", "is_LibSVM"), ("text", "is_Text")) if _yes(root.findtext(f"sample/save_type/{tag}"))]
    split = {k: float(_name(root, f"sample/split/{k}", "0") or 0) for k in ("train", "val", "test")}
    context = [_feature(f) for p in ("contenxt_features", "context_features") for f in root.findall(f"action_data/{p}/feature")]
    return WideSpec(task, _name(root, "data_type", "user"), _name(root, "action_data/label_name", "label"), int(rate), split, _name(root, "sample/save_path/root_path"), formats, (root.findtext("action_data/input") or "").strip(), [e.attrib["name"] for e in root.findall("action_data/ids/id")], context, tables, normal_crosses(crosses), id_features, {k: _name(root, k) for k in ("debug", "correlation")})
