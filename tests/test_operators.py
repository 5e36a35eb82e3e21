import json
import math
import shutil

import pytest
from pyspark.sql import functions as F

from skeinwork.functions import scoring
from skeinwork.functions import text as tf
from skeinwork.operators import distill, graph, inference, monitor
from skeinwork.plans import epoch
from skeinwork.sources import files


def losses(spark, values, name="loss"):
    return spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], f"run string, step long, {name} double")


@pytest.mark.parametrize(
    ("values", "threshold", "want"),
    [([2.5, 2.2, 2.0, 2.0, 2.01, 2.02], 0.0, 5), ([3.0, 2.0, 1.0], 0.0, None), ([2.0, 1.99, 1.98, 1.97], 0.05, 3), ([math.nan] * 3, 0.0, 2), ([2.0, None, 1.0], 0.0, None)],
)
def test_early_stopping(spark, values, threshold, want):
    assert monitor.early_stopping(losses(spark, values), threshold=threshold).first().stop_step == want


@pytest.mark.parametrize(("values", "want"), [([1.0, math.nan, 2.0], 1), ([1.0, 2.0, -math.inf], 2), ([1.0, 2.0], None)])
def test_bad_loss(spark, values, want):
    assert monitor.first_bad_loss(losses(spark, values)).first().bad_step == want


def test_loss_shapes(spark):
    assert monitor.loss_spikes(losses(spark, [1.0, 1.1, 1.0, 1.0, 5.0])).first().spike_step == 4
    assert monitor.divergence(losses(spark, [1.0, math.inf])).first().diverged
    assert monitor.converging(losses(spark, [3.0, 2.5, 2.0, 1.0, 0.9, 0.8])).first().converging
    assert monitor.plateau(losses(spark, [2.0, 1.0, 1.01, 1.0])).first().plateau
    assert not monitor.plateau(losses(spark, [1.0, 1.01, 1.0])).first().plateau
    both = spark.createDataFrame([("r", i, 2.0 - i, 1.0 + i) for i in range(4)], "run string, step long, train_loss double, val_loss double")
    assert monitor.fit_trend(both).first().overfit
    assert monitor.gradient_health(losses(spark, [1.0, 1e-8, 1e-9, 1e-10])).first().vanishing
    assert monitor.best_checkpoint(losses(spark, [2.0, 1.0, 1.0])).first().step == 1


def epochs(spark, scores, rates=None):
    rows = [("r", i + 1, s, (rates or [0.5] * len(scores))[i], 3) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "run string, epoch int, avg_score double, rate double, n_corrections long")


@pytest.mark.parametrize(
    ("scores", "rates", "patience", "want"),
    [([9.0], None, 3, "not enough epochs"), ([8.0, 8.0, 8.0], None, 3, "score"), ([8.5, 8.2, 7.0], None, 3, "in progress"), ([9.0, 6.0] * 4, None, 3, "in progress"), ([5.0, 5.0, 5.0], [0.09, 0.05, 0.0], 3, "rate"), ([5.0, 5.0, 5.0], [0.10, 0.05, 0.0], 3, "in progress")],
)
def test_convergence(spark, scores, rates, patience, want):
    checked = distill.convergence(epochs(spark, scores, rates), patience=patience)
    assert checked.orderBy(F.desc("epoch")).first().reason == want


def test_worst_and_summary(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate([8.0, 3.0, 9.0, 5.5, 6.0])], "id int, score double")
    assert [r.score for r in distill.worst(rows, "id").collect()] == [3.0, 5.5, 6.0]
    row = distill.score_summary(rows, cap=2).first()
    assert (row.below_5, row.from_5_to_7, row.from_7_to_9, row.above_9, row.n_poor, row.correction_rate) == (1, 2, 1, 1, 2, 0.4)
    empty = distill.score_summary(rows.limit(0)).first()
    assert (empty.avg_score, empty.correction_rate) == (0.0, 0.0)


def test_one_decimal_equals_printf(spark):
    values = [i / 1000 for i in range(0, 10001, 7)] + [i / 20 for i in range(201)] + [3.25, 0.05, 8.05, 9.949999, 9.95]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", distill.one_decimal(F.col("x")).alias("t")).collect()
    assert [(r.x, r.t) for r in got if r.t != f"{r.x:.1f}"] == []


def test_generate_and_retry(spark):
    waits, calls = [], []

    def throttled(prompt, system):
        calls.append(prompt)
        if len(calls) < 3:
            raise inference.ServiceError("ThrottlingException")
        return {"content": [{"text": "ok"}], "usage": {"output_tokens": 5}}

    assert inference.call_with_retry(throttled, "p", None, 3, 0.1, waits.append)["success"]
    assert waits == [0.1, 0.2]
    denied = []
    assert not inference.call_with_retry(lambda p, s: denied.append(p) or (_ for _ in ()).throw(inference.ServiceError("AccessDenied")), "p")["success"]
    assert len(denied) == 1
    assert inference.call_with_retry(lambda p, s: {"content": []}, "p")["error"] == "Empty response"
    prompts = spark.createDataFrame([("2", "b"), ("10", "a"), ("3", ""), ("4", None)], "id string, prompt string")
    done = inference.generate(prompts, lambda p, s: {"content": [{"text": p.upper()}], "usage": {"input_tokens": 1, "output_tokens": 500}}, "now", 2)
    assert [(r.id, r.response) for r in inference.by_text_id(done).collect()] == [("10", "A"), ("2", "B")]
    assert inference.batch_summary(done).first().output_tokens == 1000


def test_system_prompt_and_default_ids(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"prompt": "a"}\n{"id": "x", "prompt": "b"}\n{"prompt": ""}\n{"prompt": "c"}\n')
    prompts = files.read_prompts(spark, str(tmp_path / "p.jsonl"))
    done = inference.generate(prompts, lambda p, s: {"content": [{"text": f"{s}:{p}"}]}, "now", 2, system="told")
    assert sorted((r.id, r.response) for r in done.collect()) == [("0", "told:a"), ("3", "told:c"), ("x", "told:b")]


def test_epoch(spark, tmp_path):
    outputs = spark.createDataFrame([("a", "tsn vlan eth", "goto x\nmalloc(1) free(2)\n(((("), ("b", "sort", "int ok;")], "id string, prompt string, output string")
    training = spark.createDataFrame([([("user", "q"), ("assistant", "r")],)], "messages array<struct<role:string,content:string>>")
    summary, fixed, after = epoch.run_epoch(outputs, training, lambda p, s: {"content": [{"text": "better"}]}, 2, "now", str(tmp_path))
    assert summary.first().n == 2
    assert [(r.id, r.teacher_correction) for r in fixed.collect()] == [("a_correction_e2", "better")]
    assert after.count() == 2
    lines = [json.loads(x) for p in (tmp_path / "accumulated_corrections.jsonl").glob("*.json") for x in p.read_text().splitlines()]
    assert [x["id"] for x in lines] == ["a_correction_e2"]


GOOD = """
        struct tsn_frame {
            uint8_t pcp;
            uint16_t vlan_id;
            uint64_t timestamp;
            uint8_t priority;
        };
        """


def test_known_scores_by_the_compilers_score(spark):
    """The two samples with what a compiler gives them: no warning, and one error."""
    rows = [(GOOD, 10.0, 9.25), ("void foo() { goto error; }", 4.0, 5.35)]
    frame = spark.createDataFrame(rows, "code string, syntax double, want double")
    q = scoring.quality(F.col("code"), F.lit("Generate TSN code"), F.col("syntax"))
    assert all(round(r.got, 6) == r.want for r in frame.select(q["overall"].alias("got"), "want").collect())


def test_compiler_is_told_and_read(tmp_path):
    """A stand-in for the compiler that notes its flags and says what it is asked to say."""
    for name, says, code, want in (("none", "", 0, 10.0), ("two", "warning: a\nwarning: b", 0, 8.0), ("many", "warning: a\n" * 9, 0, 7.0), ("wrong", "error: a\nwarning: b", 1, 4.0), ("odd", "", 1, 6.0)):
        (tmp_path / f"{name}.txt").write_text(says)
        tool = tmp_path / name
        tool.write_text(f'#!/bin/sh\necho "$@" > {tmp_path}/flags\ncat {tmp_path}/{name}.txt >&2\nexit {code}\n')
        tool.chmod(0o755)
        assert inference.compile_score("int x;", str(tool)) == want
        flags = (tmp_path / "flags").read_text().split()
        assert flags[:-1] == ["-fsyntax-only", "-std=c99", "-Wall", "-Wextra", "-Wno-unused-variable", "-Wno-unused-parameter"]


@pytest.mark.skipif(not shutil.which("gcc") or inference.compile_score("int x;") != 10.0, reason="no working C compiler")
def test_scores_with_the_compiler(spark):
    """Known scores of two samples, and that unused parameters and variables cost nothing."""
    rows = [("good", GOOD, "Generate TSN code"), ("bad", "void foo() { goto error; }", "Generate TSN code"), ("unused", "int f(int a) { int b; return 0; }", ""), ("blank", " \n", "")]
    frame = spark.createDataFrame(rows, "id string, output string, prompt string")
    got = {r.id: (r.quality.syntax, round(r.score, 6)) for r in epoch.score_outputs(frame, compiler=True).collect()}
    assert got["good"][1] == 9.25 and got["bad"][1] == 5.35
    assert got["unused"][0] == 10.0 and got["blank"][0] == 0.0


def test_embed_and_compile(spark):
    rows = spark.createDataFrame([(1, "ab"), (2, None)], "id int, t string")
    assert [list(r.embedding) for r in inference.embed(rows, lambda ts: [[float(len(t))] for t in ts], "t").orderBy("id").collect()] == [[2.0], [0.0]]
    assert inference.compile_score("int x = 1;", compiler="no-such-compiler") == 5.0


def test_search_threshold_after_top_k(spark):
    contexts = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])], "id long, embedding array<float>")
    edges = spark.createDataFrame([(1, "t"), (1, "u")], "src long, dst string")
    topics = spark.createDataFrame([("t", "topic"), ("u", "under")], "id string, name string")
    kinds = {"topics": (edges, topics, "name")}
    assert [r.id for r in graph.search(contexts, [1.0, 0.0], kinds, 10).collect()] == [1, 2]
    rows = graph.search(contexts, [1.0, 0.0], kinds, 1).collect()
    assert [(r.id, list(r.topics)) for r in rows] == [(1, ["topic", "under"])]


def test_batch_search_in_blocks(spark, monkeypatch):
    """Against brute force, over blocks, with ties, zero and odd vectors."""
    monkeypatch.setattr(graph, "QUERY_BLOCK", 3)
    monkeypatch.setattr(graph, "VECTOR_BLOCK", 4)
    vectors = {i: [math.cos((i % 15) ** 2 / 100), math.sin((i % 15) ** 2 / 100)] for i in range(40)}
    odd = [(90, [0.0, 0.0]), (91, None), (92, [1.0]), (93, [])]
    rows = spark.createDataFrame([*vectors.items(), *odd], "id long, embedding array<float>")
    got = graph.nearest_batch(rows, rows.filter("id < 9 or id >= 90"), 3).collect()
    for q in range(9):
        scores = {i: round(sum(a * b for a, b in zip(vectors[q], v, strict=True)), 6) for i, v in vectors.items() if i != q}
        want = sorted(scores, key=lambda i: (-scores[i], i))[:3]
        assert [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want
    assert {r.query_id for r in got} == set(range(9))
    assert [r.id for r in graph.nearest(rows, [1.0, 0.0], 2).collect()] == [0, 15]
    assert graph.nearest(rows, [0.0, 0.0], 2).collect() == []
    assert graph.nearest_batch(rows.limit(0), rows, 2).collect() == graph.nearest_batch(rows, rows.limit(0), 2).collect() == []


def test_ingest_links_known_topics(spark):
    schema = "id string, summary string, full_text string, session_id string, project string, timestamp timestamp, embedding array<float>, topics array<string>"
    rows = spark.sql("SELECT 'a' id, 's' summary, 'see x/y.py def f(' full_text, 'S' session_id, 'P' project, timestamp'2024-01-01' timestamp, array(1f) embedding, array('t') topics UNION ALL SELECT 'b', 's', 'def f( again', 'S', 'Q', timestamp'2024-01-02', array(1f), array('t')")
    assert len(schema.split(",")) == len(rows.columns)
    made = {k: v.collect() for k, v in graph.ingest(rows).items()}
    assert [(r.src, r.dst) for r in made["follows"]] == [("b", "a")]
    assert len(made["topics"]) == 1 and len(made["contains_topic"]) == 2
    assert len(made["entities"]) == 2 and len(made["references_code"]) == 3
    assert [(r.project) for r in made["sessions"]] == ["P"]


def test_entities_and_chat(spark):
    text = "Look at src/main.c and (lib/a.b.py). def run(x) class Car: def run(y) class Van("
    row = spark.createDataFrame([(text,)], "t string").select(tf.code_entities(F.col("t")).alias("e")).first()
    assert [tuple(e) for e in row.e] == [("src/main.c", "file", "main"), ("lib/a.b.py", "file", "a.b"), ("", "function", "run"), ("", "class", "Car"), ("", "class", "Van")]
    chat = spark.createDataFrame([([("user", "hi"), ("tool", "x"), ("assistant", "yo")],)], "m array<struct<role:string,content:string>>")
    assert chat.select(tf.render_chat(F.col("m")).alias("c")).first().c == "<|user|>\nhi\n<|assistant|>\nyo\n"


def test_validation(spark):
    good = spark.createDataFrame([([("user", "q")],)] * 3, "messages array<struct<role:string,content:string>>")
    assert monitor.validate_datasets(good, good) == []
    bad = spark.createDataFrame([(None,), ([],), ([(None, "x")],)], good.schema)
    assert len(monitor.validate_datasets(bad, good.limit(1))) == 3
    assert monitor.validate_datasets(good.limit(0), good.limit(0)) == ["error: training set is empty", "error: validation set is empty"]
