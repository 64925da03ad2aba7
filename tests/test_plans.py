import pytest
from pyspark.sql import DataFrame

from samplewright.plans import nodes  # noqa: F401
from samplewright.plans import workflow as W
from samplewright.plans.spec import read_wide_spec


@W.node("test_source")
class Source(W.Node):
    takes = (0, 0)

    def run(self) -> DataFrame:
        return self.spark.range(int(self.get("n", 3)))


@W.node("test_stop")
class Stop(W.Node):
    def run(self, df: DataFrame) -> DataFrame:
        raise W.Terminated


@W.node("test_number")
class Number(W.Node):
    takes = (0, 0)

    def run(self) -> int:
        return 1


def job(nodes_xml, props=""):
    return W.build_job(f'<job name="j"><pipeline name="p"><properties>{props}</properties>{nodes_xml}</pipeline></job>')


SOURCE = '<node id="a" processor="test_source"><properties><property key="n" value="5"/></properties></node>'


def sql(id, dep, text):
    return f'<node id="{id}" processor="sql"><properties><property key="sql" value="{text}"/></properties><dependency><node id="{dep}" input="df"/></dependency></node>'


def test_properties_by_precedence(spark):
    def make(own=True):
        return job(SOURCE if own else '<node id="a" processor="test_source"/>', '<property key="n" value="4"/>')

    count = lambda cli, own=True: W.run_job(spark, lambda: make(own), cli)["p"]["a"].count()
    assert [count({}, False), count({}), count({"n": "6"}), count({"n": "6", "a.n": "7"})] == [4, 5, 6, 7]


def test_fan_out_and_early_end(spark):
    j = job(SOURCE + sql("b", "a", "SELECT max(id) AS m FROM tmp_table") + sql("c", "a", "SELECT min(id) AS m FROM tmp_table") + '<node id="d" processor="test_stop"><dependency><node id="c" input="df"/></dependency></node>')
    done = W.run_job(spark, lambda: j, {})["p"]
    assert done["b"].head().m == 4 and done["c"].head().m == 0 and "d" not in done
    assert j.pipelines[0].nodes["d"].state == W.State.TERMINATED and j.pipelines[0].nodes["b"].state == W.State.COMPLETED


def test_wrong_workflows():
    with pytest.raises(W.DependencyError):
        job(sql("a", "b", "x") + sql("b", "a", "x"))
    with pytest.raises(W.DependencyError):
        job(sql("a", "nope", "x"))
    with pytest.raises(W.FlowError, match="takes DataFrame"):
        job('<node id="n" processor="test_number"/>' + sql("b", "n", "x"))
    with pytest.raises(W.FlowError, match="unknown processor"):
        job('<node id="a" processor="os.system"/>')
    with pytest.raises(W.FlowError):
        W.build_job("<job/>")
    with pytest.raises(W.FlowError):
        W.parse_arguments(["novalue"])


def test_backfill_and_failure(spark):
    out = W.run_job(spark, lambda: job(SOURCE), {"dataTime": "20240301", "regression": "2"})
    assert sorted(out) == ["p@20240229", "p@20240301"]
    with pytest.raises(W.FlowError, match="failed"):
        W.run_job(spark, lambda: job(SOURCE + sql("b", "a", "SELECT nope FROM tmp_table")), {})


def test_node_chain(spark, tmp_path):
    spark.createDataFrame([(str(i), f"u{i}", str(i % 7), str(i * 3)) for i in range(50)], "a string, b string, c string, conv_num string").write.csv(str(tmp_path / "in" / "20240101"))
    xml = f"""<job name="j"><pipeline name="p">
    <node id="load" processor="load_text"><properties><property key="rootPath" value="{tmp_path}/in"/><property key="inputPath" value="20240101-20240102"/><property key="path_type" value="date"/><property key="field_list" value="a;b;c;conv_num"/></properties></node>
    <node id="typed" processor="sql"><properties><property key="sql" value="SELECT CAST(c AS float) AS c, CAST(conv_num AS float) AS conv_num FROM tmp_table"/></properties><dependency><node id="load" input="df"/></dependency></node>
    <node id="bins" processor="discretize"><properties><property key="learn" value="c"/><property key="bins" value="3"/></properties><dependency><node id="typed" input="df"/></dependency></node>
    <node id="cut" processor="sampling"><dependency><node id="bins" input="df"/></dependency></node>
    <node id="svm" processor="libsvm"><properties><property key="label_idx" value="3"/></properties><dependency><node id="load" input="df"/></dependency></node>
    <node id="out" processor="save"><properties><property key="outputPath" value="{tmp_path}/out"/></properties><dependency><node id="bins" input="df"/></dependency></node>
    </pipeline></job>"""
    done = W.run_job(spark, lambda: W.build_job(xml), {})["p"]
    rows = done["bins"].collect()
    assert {r.label for r in rows} == {0, 1} and {r.c for r in rows} <= {1, 2, 3} and sum(r.label for r in rows) == 13
    assert set(done["cut"].columns) >= {"label", "split"} and done["svm"].count() == 50
    assert spark.read.csv(f"{tmp_path}/out").count() == 50


def test_wide_spec():
    spec = read_wide_spec("""<config><task_type name="train"/><data_type name="user"/><sample><labelrate name="3"/><split><train name="0.8"/></split><save_type><is_Text>true</is_Text></save_type></sample>
    <action_data><input>db::t</input><label_name name="y"/><ids><id name="uid"/></ids><contenxt_features><feature feature_name="hour" feature_type="category" isencode="1"/></contenxt_features></action_data>
    <feature_collect><feature_data norm_name="f" time="last"><input>db::f</input><features><feature feature_name="age" value_field="v1" isdiscretize="true" discretize_argv="5"/></features><id_conf id_field="uid" join_field="uid"/></feature_data></feature_collect>
    <gen_feature><features name="comb_features"><feature name="x" dependencies="age|hour"/><feature name="b" dependencies="hour;age"/></features><features name="id_features"><feature name="age"/></features></gen_feature></config>""")
    assert spec.feature_index() == {"age": 0, "hour": 1} and spec.crosses == {"b": ["age", "hour"]} and spec.formats == ["text"]
    assert spec.tables[0].from_id == "uid" and spec.tables[0].features[0].bins == 5 and spec.label_rate == 3
    with pytest.raises(ValueError):
        read_wide_spec("<config/>")


WIDE = """<config><task_type name="{task}"/><sample><labelrate name="1"/><split><train name="0.5"/><test name="0.5"/></split><save_path><root_path name="{root}"/></save_path><save_type><is_Text>1</is_Text><is_LibSVM>1</is_LibSVM></save_type></sample>
<action_data><input>{dir}/action</input><label_name name="label"/><ids><id name="uid"/></ids><context_features><feature feature_name="n" value_field="x" isdiscretize="1" discretize_argv="4" isencode="1"/></context_features></action_data>
<feature_collect><feature_data norm_name="user" time="-1"><input>{dir}/user</input><features><feature feature_name="tags" value_field="t" feature_type="multi" top="2" operator="identity"/><feature feature_name="city" value_field="c" feature_type="category" isencode="1"/></features><id_conf id_field="uid"/></feature_data></feature_collect>
<gen_feature><features name="comb_features"><feature name="both" dependencies="city|n"/></features><features name="id_features"><feature name="city"/><feature name="n"/><feature name="gone"/></features></gen_feature></config>"""


def test_wide_job(spark, tmp_path):
    from samplewright.plans import wide

    where = str(tmp_path)
    make = lambda rows, shape, name: spark.createDataFrame(rows, shape).write.parquet(f"{where}/{name}")
    make([("1", float(v), v % 2) for v in range(1, 9)] + [("9", None, 1), (None, 3.0, 0)], "uid string, x double, label int", "action")
    make([("1", "a:1,b:3,c:2", "rome", "p_20240102"), ("1", "z", "oslo", "p_20240102"), ("9", None, None, "p_20240102"), ("1", "old", "old", "p_20240101")], "uid string, t string, c string, part string", "user")
    parsed = lambda task, root="": read_wide_spec(WIDE.replace("{task}", task).replace("{dir}", where).replace("{root}", root))
    out = wide.run(spark, parsed("predict"), "20240102")
    assert out.frame.columns == ["uid", "label", "city", "n", "both"]
    rows = sorted(((r.uid or "", r.label, r.city or "", r.n, r.both or "") for r in out.frame.collect()), key=str)
    # of two rows of one user one counts, whole; bins of 1..8 in fours, then ids of bins: "-1" (missing) first
    assert len(rows) == 10 and {r[2] for r in rows if r[0] == "1"} in ({"0"}, {"1"}) and sum(r[0] == "9" for r in rows) == 1
    assert [r[3] for r in rows if r[0] == "9"] == ["0"] and {r[3] for r in rows} == {"0", "1", "2", "3", "4"}
    assert all((r[4] == f"{r[2]}_{r[3]}") == (r[2] != "") for r in rows)
    # learned artefacts are used again
    written = wide.learn_artefacts(spark, parsed("train"), "20240102", f"{where}/made", bins=4, few=0, least=0)
    assert sorted(p.removeprefix(f"{where}/made/") for p in written) == ["discretize/action", "index/user"]
    again = wide.build(spark, parsed("predict"), "20240102", artefacts=f"{where}/made")
    assert sorted(again.frame.columns) == sorted(out.frame.columns) and again.dictionaries["user"].count() == 2
    done = wide.run(spark, parsed("train", f"{where}/samples"), "20240102")
    assert any(p.endswith("20240102train_text") for p in done.written) and spark.read.text(f"{where}/samples/20240102libsvm_map").count() > 0
    with pytest.raises(ValueError, match="no column"):
        make([("1",)], "other string", "bad")
        wide.build(spark, read_wide_spec(WIDE.replace("{task}", "predict").replace("{dir}/user", f"{where}/bad").replace("{dir}", where).replace("{root}", "")), "20240102")
