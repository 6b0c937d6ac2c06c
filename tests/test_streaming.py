import os

import pytest
from pyspark.sql import functions as F

from tableflow.session import scratch_path
from tableflow.streaming import FlowSpec, read_flow_output, run_flows


def _local(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def _write(path, name, data: bytes):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), name), "wb") as f:
        f.write(data)


@pytest.fixture()
def flows(spark):
    # X7: four spool directories
    root = scratch_path(spark, "flows-t")
    _write(f"{root}/customer", "c1.txt", b"alice\nbob\n")
    _write(f"{root}/shop", "s1.txt", b"shop-a\n")
    _write(f"{root}/special_file", "sp.txt", "café €5\nplain\n".encode("cp1252"))
    _write(f"{root}/long_file", "l.txt", ("x" * 5000 + "\n").encode())
    specs = {
        "customer": FlowSpec(f"{root}/customer", f"{root}/out/customer"),
        "shop": FlowSpec(f"{root}/shop", f"{root}/out/shop"),
        "special_file": FlowSpec(f"{root}/special_file", f"{root}/out/special_file", charset="windows-1252"),
        "long_file": FlowSpec(f"{root}/long_file", f"{root}/out/long_file", max_line_length=4600),
    }
    return root, specs


def test_four_flows(spark, flows):
    root, specs = flows
    run_flows(spark, specs)
    out = {n: read_flow_output(spark, s) for n, s in specs.items()}
    assert sorted(r.value for r in out["customer"].collect()) == ["alice", "bob"]
    assert {r.basename for r in out["customer"].collect()} == {"c1.txt"}
    assert sorted(r.value for r in out["special_file"].collect()) == ["café €5", "plain"]
    assert sorted(len(r.value) for r in out["long_file"].collect()) == [400, 4600]


def test_restart_no_loss_no_duplicates(spark, flows):
    root, specs = flows
    spec = specs["customer"]
    run_flows(spark, {"c": spec})
    _write(f"{root}/customer", "c2.txt", b"carol\n")
    run_flows(spark, {"c": spec})
    run_flows(spark, {"c": spec})
    assert sorted(r.value for r in read_flow_output(spark, spec).collect()) == ["alice", "bob", "carol"]


def test_default_limit_cuts_lines(spark):
    # N6
    root = scratch_path(spark, "n6")
    lens = [0, 1, 2047, 2048, 2049, 4096, 4097]
    _write(f"{root}/in", "n6.txt", "\n".join("y" * n for n in lens).encode() + b"\n")
    spec = FlowSpec(f"{root}/in", f"{root}/out")
    run_flows(spark, {"n6": spec})
    got = sorted(len(r.value) for r in read_flow_output(spark, spec).collect())
    assert got == sorted([0, 1, 2047, 2048, 2048, 1, 2048, 2048, 2048, 2048, 1])


def test_undeclared_charset_fails(spark):
    root = scratch_path(spark, "badcs")
    _write(f"{root}/in", "b.txt", "café\n".encode("cp1252"))
    with pytest.raises(Exception):
        run_flows(spark, {"bad": FlowSpec(f"{root}/in", f"{root}/out")})


def test_archive_consumed_files(spark):
    from tableflow.streaming import start_flow

    root = scratch_path(spark, "archive")
    _write(f"{root}/in", "a.txt", b"one\ntwo\n")
    spec = FlowSpec(f"{root}/in", f"{root}/out", archive_dir=f"{root}/archived")
    run_flows(spark, {"a": spec})
    _write(f"{root}/in", "b.txt", b"three\n")
    run_flows(spark, {"a": spec})
    assert sorted(r.value for r in read_flow_output(spark, spec).collect()) == ["one", "three", "two"]
    archived = [f for _, _, fs in os.walk(_local(f"{root}/archived")) for f in fs]
    assert "a.txt" in archived
    assert not os.path.exists(os.path.join(_local(f"{root}/in"), "a.txt"))


def test_continuous_trigger(spark):
    from tableflow.streaming import start_flow

    root = scratch_path(spark, "cont")
    _write(f"{root}/in", "a.txt", b"x\ny\n")
    spec = FlowSpec(f"{root}/in", f"{root}/out", available_now=False, interval_seconds=1)
    q = start_flow(spark, "cont", spec)
    try:
        q.processAllAvailable()
        _write(f"{root}/in", "b.txt", b"z\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.value for r in read_flow_output(spark, spec).collect()) == ["x", "y", "z"]


def test_declared_utf8_is_strict(spark):
    root = scratch_path(spark, "utf8strict")
    _write(f"{root}/in", "b.txt", "café\n".encode("cp1252"))
    with pytest.raises(Exception):
        run_flows(spark, {"u": FlowSpec(f"{root}/in", f"{root}/out", charset="UTF-8")})


def test_backlog_in_bounded_batches(spark):
    root = scratch_path(spark, "backlog")
    for i in range(5):
        _write(f"{root}/in", f"f{i}.txt", f"line{i}\n".encode())
    spec = FlowSpec(f"{root}/in", f"{root}/out", max_files_per_trigger=2)
    q = run_flows(spark, {"b": spec})["b"]
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    assert sorted(r.value for r in read_flow_output(spark, spec).collect()) == [f"line{i}" for i in range(5)]


def test_write_spool_leaves_session_conf_alone(spark):
    from tableflow.streaming import write_spool

    before = spark.conf.get("spark.sql.legacy.javaCharsets", "false")
    docs = spark.createDataFrame([("a", "café\nok")], "flow string, text string")
    root = scratch_path(spark, "spool-conf")
    write_spool(docs, root, "flow", charset="windows-1252")
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == before
    raw = open([os.path.join(d, f) for d, _, fs in os.walk(_local(root)) for f in fs if f.endswith(".txt")][0], "rb").read()
    assert raw == "café\nok\n".encode("cp1252")


def test_specs_from_sections():
    import configparser

    from tableflow.streaming import specs_from_sections

    cfg = configparser.RawConfigParser()
    cfg.optionxform = str
    cfg.read_string("""
[DEFAULT]
agent=a1
[customer]
spoolDir=/in/customer
HDFSDir=/out/customer
[special_file]
spoolDir=/in/sp
HDFSDir=/out/sp
inputCharset=windows-1252
maxLineLength=4600
""")
    specs = specs_from_sections({s: dict(cfg[s]) for s in cfg.sections()})
    assert set(specs) == {"customer", "special_file"}
    assert specs["customer"].max_line_length == 2048 and specs["customer"].charset is None
    assert specs["special_file"].charset == "windows-1252" and specs["special_file"].max_line_length == 4600
    with pytest.raises(ValueError):
        specs_from_sections({"bad": {"spoolDir": "/x"}})


def test_numeric_base_names_stay_text(spark):
    root = scratch_path(spark, "numnames")
    _write(f"{root}/in", "0123", b"a\n")
    spec = FlowSpec(f"{root}/in", f"{root}/out")
    run_flows(spark, {"n": spec})
    out = read_flow_output(spark, spec)
    assert dict(out.dtypes)["basename"] == "string" and out.first().basename == "0123"
