import json
import random
import re

from pyspark.sql import functions as F

from skeinwork.functions import text as tf
from skeinwork.operators import examples, splits
from skeinwork.plans import corpus
from skeinwork.sources import files

HEAD = re.compile(examples.FUNCTION_HEAD)


def plain_functions(code):
    out = []
    for m in HEAD.finditer(code):
        depth, i = 1, m.end()
        while i < len(code) and depth:
            depth += {"{": 1, "}": -1}.get(code[i], 0)
            i += 1
        body = code[m.start() : i]
        if len(body) >= 50:
            out.append((m[2].strip(), m[1].strip(), m[3].strip(), body, body.count("\n")))
    return out


def test_functions_on_random_texts(spark):
    rng = random.Random(3)
    tokens = ["int ", "f1", "g2", "(", ")", "{", "}", "int a", "\n", "static ", "const ", "char *", "x;", " if (x) {", "return 0;", "// brace } in a comment\n", " void h(int a, int b) {", "é "]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["", "/* none */", "int main(void) { return 0; }", "int longer_name(int a)\n{\n" + "  a += 1;\n" * 9 + "}\nchar* two(char *s) {\n" + "  s++;\n" * 9]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, code string")
    for r in frame.select("i", examples.functions_in(F.col("code")).alias("fs")).collect():
        assert [tuple(f) for f in r.fs] == plain_functions(texts[r.i]), texts[r.i]


def test_many_functions_in_linear_time(spark):
    code = "".join(f"int f{i}(int a) {{\n    return a + {i}; // a line of some length to count\n}}\n" for i in range(20000))
    assert len(code) > 1_000_000
    row = spark.createDataFrame([(code + "w" * 1_000_000,), (None,)], "code string").select(F.size(examples.functions_in(F.col("code"))).alias("n"))
    assert sorted(r.n for r in row.collect()) == [0, 20000]


def test_examples_name_their_source(spark):
    body = "\n".join(f"    total += table[{i}];" for i in range(12))
    rows = spark.createDataFrame([("p", "d", ["CAN"], f"int sum(int total) {{\n{body}\n    return total;\n}}\n")], "path string, domain string, contexts array<string>, code string")
    made = examples.training_examples(rows).collect()
    assert len(made) == 2 and {r.metadata.source for r in made} == {"automotive_codebase"}


def test_strict_leaves_out_control_words(spark):
    code = "int work(int a) {\n  do_it(); else if (a > 1) {\n" + "  x();\n" * 12 + "}\n}"
    rows = spark.createDataFrame([(code,)], "code string")
    names = lambda strict: [f.name for f in rows.select(examples.functions_in(F.col("code"), strict).alias("x")).first().x]
    assert names(False) == ["work", "if"] and names(True) == ["work"]


def test_completion(spark):
    lines = "\n".join(f"int line_{i} = {i};" for i in range(20))
    rows = spark.createDataFrame([(0, lines), (1, "a\nb"), (2, "/*" + "x" * 300 + "*/")], "i int, code string")
    parts = {r.i: r.p for r in rows.select("i", examples.completion_parts(F.col("code")).alias("p")).collect()}
    assert parts[0].split_at == 10 and parts[0].prefix + "\n" + parts[0].suffix == lines
    assert parts[1] is None and parts[2] is None


def test_decode(spark):
    cases = [(b"int x;\r\ny\rz", "int x;\ny\nz"), (b"// Caf\xe9\n", "// Café\n"), (bytes(range(256)), None), (b"", ""), ("é".encode(), "é")]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, content binary")
    got = {r.i: r.t for r in rows.select("i", tf.decode_code(F.col("content")).alias("t")).collect()}
    assert all(want is None or got[i] == want for i, (_, want) in enumerate(cases))
    assert len(got[2]) == 256


def test_split_sizes(spark):
    for n, ratio, want in ((100, 0.9, 90), (50, 0.8, 40), (1, 0.9, 0), (0, 0.9, 0)):
        rows = spark.range(n).select(F.col("id").cast("string").alias("key"))
        once = {r.key: r.split for r in splits.exact_split(rows, "key", ratio).collect()}
        again = {r.key: r.split for r in splits.exact_split(rows.repartition(3), "key", ratio).collect()}
        assert once == again and len(once) == n and sum(v == "train" for v in once.values()) == want


def test_dedup_first_wins(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "z"), (None, 4, "q"), (None, 5, "r")], "k string, at int, v string")
    kept = splits.deduplicate(rows, ["k"], ["at"])
    assert kept.columns == rows.columns
    assert sorted((str(r.k), r.at) for r in kept.collect()) == [("None", 4), ("a", 1), ("b", 3)]


def test_files_to_splits(spark, tmp_path):
    body = "\n".join(f"    total += table[{i}];" for i in range(12))
    for i in range(6):
        folder = tmp_path / "in" / ("tsn_data" if i % 2 else "avb_data/deep")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i}.c").write_text(f"int sum_{i}(int total) {{\n{body}\n    return total;\n}}\n")
    (tmp_path / "in/tsn_data/skip.C").write_text("int upper(void) { return 0; }")
    (tmp_path / "in/tsn_data/empty.h").write_text("")
    (tmp_path / "in/elsewhere").mkdir()
    (tmp_path / "in/elsewhere/g.c").write_text("int no_source(void) {}")
    made = corpus.prepare(spark, str(tmp_path / "in")).cache()
    assert made.count() == 12
    assert {r.domain: r.n for r in corpus.domain_counts(made).collect()} == {"tsn": 6, "avb": 6}
    assert made.filter("split = 'train'").count() == 10
    corpus.write(made, str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out/train.jsonl").glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 10 and all(set(x) == {"messages"} for x in lines)
    assert all(x["messages"][1]["content"] for x in lines)
    train, val = files.cached_splits(spark, str(tmp_path / "out"))
    assert train.count() + val.count() == 12
    assert corpus.prepare(spark, str(tmp_path / "in"), max_files=1).count() == 4
