"""The workflow's processors, each a thin wrapper of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import discretize as D
from ..operators import encode as E
from ..operators import join as J
from ..operators import pretrain as P
from ..operators import project, sample
from ..operators.aggregate import pivot_extend
from ..sources import partitions, sinks, text
from . import wide
from .spec import read_wide_spec
from .workflow import Node, node


@node("load_text")
class LoadText(Node):
    takes = (0, 0)

    def run(self) -> DataFrame:
        paths = text.date_paths(self.get("rootPath"), self.get("inputPath")) if self.get("path_type", "path") == "date" else [f"{self.get('rootPath')}/{p}" for p in self.names("inputPath")]
        fields = self.names("field_list")
        if self.get("data_type", "text") == "tfrecord":
            from ..sources.records import read_tfrecord

            return read_tfrecord(self.spark, text.present(self.spark, paths), text.string_schema(fields))
        return text.load_text(self.spark, paths, fields, self.get("delimiter", ","))


@node("load_table")
class LoadTable(Node):
    takes = (0, 0)

    def run(self) -> DataFrame:
        where = self.get("table")
        df = self.spark.read.parquet(where) if "/" in where else self.spark.table(where)
        part = self.get("partition_field", "-")
        df = df if part == "-" else partitions.load(df, part, self.get("partitions", "last"), self.get("dataTime", "")[:8])
        times = self.get("partition_times", 0, int)
        return df.repartition(partitions.parallelism(self.spark, times)) if times else df


@node("sql")
class Sql(Node):
    takes = (1, 20)

    def run(self, **frames: DataFrame) -> DataFrame:
        query = self.get("sql").replace("tmp_table", "{df}") if "df" in frames else self.get("sql")
        return project.run_sql(query, **frames)


@node("parse")
class Parse(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        return project.parse_typed(df, df.columns[0], self.get("delimiter", ","), self.names("fieldList"), self.names("typeList"), self.get("strict", "true") == "true")


@node("discretize")
class Discretize(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        saved = self.get("bounds_path", "-")
        return D.discretize_node(df, self.names("drop_fields_name", ""), self.names("learn"), None if saved == "-" else D.load_bounds(self.spark, saved), self.get("label_source", "conv_num"), self.get("label_threshold", 110.0, float), self.get("bins", 10, int), self.get("method", "equi_freq"))


@node("learn_bounds_and_index")
class LearnBoundsAndIndex(Node):
    """Bounds and category index of one table, saved under root_path."""

    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        bounds = D.learn(df, self.names("numeric"), self.get("bins", 1000, int))
        name, root = self.get("table_name"), self.get("root_path")
        D.save_bounds(bounds, f"{root}/discretize/{name}")
        index = E.feature_index(df, self.names("category", ""), self.get("few", E.FEW, int), self.get("least", E.LEAST, int)) if self.names("category", "") else None
        if index is not None:
            sinks.save(index, f"{root}/index/{name}", "parquet")
        return bounds


@node("learn_wide")
class LearnWide(Node):
    """Bounds and indices of the action table and of all feature tables of a wide-table specification, under root_path."""

    takes = (0, 0)

    def run(self) -> DataFrame:
        written = wide.learn_artefacts(self.spark, read_wide_spec(text.read_config(self.spark, self.get("config"))), self.get("dataTime", "")[:8], self.get("root_path"))
        return self.spark.createDataFrame([(p,) for p in written], "path string")


@node("wide_table")
class WideTable(Node):
    """The wide table of a specification; id mappings by the entries `from:to=path` of `mappings`."""

    takes = (0, 0)

    def run(self) -> DataFrame:
        items = [dict(zip(("id", "input"), m.split("=", 1), strict=True)) for m in self.names("mappings", "")]
        root = self.get("root_path", "-")
        return wide.run(self.spark, read_wide_spec(text.read_config(self.spark, self.get("config"))), self.get("dataTime", "")[:8], mappings=J.mapping_registry(self.spark, items), artefacts=None if root == "-" else root).frame


@node("pivot")
class Pivot(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        return pivot_extend(df, self.get("key_field"), self.get("extend_field"), self.names("field_value_list"))


@node("join_tables")
class JoinTables(Node):
    """Input `df` is the action table; the others are feature tables named by
    their inputs, with {name}.id, {name}.join and {name}.features."""

    takes = (1, 50)

    def run(self, df: DataFrame, **tables: DataFrame) -> DataFrame:
        specs = [J.FeatureTable(t, self.get(f"{n}.id"), self.get(f"{n}.join"), self.names(f"{n}.features")) for n, t in tables.items()]
        return J.feature_collect(df, specs, self.names("keep", "") or None)


@node("union")
class Union(Node):
    takes = (1, 50)

    def run(self, **frames: DataFrame) -> DataFrame:
        first, *rest = frames.values()
        for f in rest:
            first = first.unionByName(f)
        return first.distinct() if self.get("distinct", "false") == "true" else first


@node("sampling")
class Sampling(Node):
    """Label, cut the other group to `times` the positives, split; saved by split where a path is given."""

    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        labelled = project.add_label(df, self.get("label_source"), self.get("label_threshold", 110.0, float)) if self.get("label_source", "-") != "-" else df
        kept = sample.by_field(labelled, "label", 1, self.get("times", 1.0, float))
        out = sample.hash_split(kept, kept.columns, ["train", "val", "test"], [float(x) for x in self.names("split", "0.7,0.15,0.15")])
        if self.get("output", "-") != "-":
            sinks.save_splits(out, f"{self.get('output')}/", self.get("dataTime", ""), self.names("formats", "text"))
        return out


@node("pretrain")
class Pretrain(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        return P.pretrain_samples(df, self.get("id_field", "wuid"), self.names("fields"), None, self.get("least", 10_000, int), self.get("most", 10_000_000, int))[0]


@node("libsvm")
class Libsvm(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        label = df.columns[self.get("label_idx", 0, int)]
        ids = [c for c in df.columns[: self.get("drop_first", 2, int)] if c != label]
        columns = [c for c in df.columns if c not in ids and c != label]
        index = E.libsvm_index(df, columns)
        if self.get("map_path", "-") != "-":
            sinks.save(E.libsvm_map(index), self.get("map_path"), "lines")
        rows = df.withColumn("_row", F.monotonically_increasing_id())
        return E.libsvm_rows(rows, label, columns, index, ["_row"]).select(col("line"))


@node("save")
class Save(Node):
    takes = (1, 1)

    def run(self, df: DataFrame) -> DataFrame:
        sinks.save(self.coalesced(df), self.get("outputPath"), self.get("save_type", "text"))
        return df
