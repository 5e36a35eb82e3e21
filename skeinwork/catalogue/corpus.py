"""Queries of corpus preparation: discovery, examples, dedup, splits, leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tf
from ..operators import examples, manifest, monitor, splits
from ..plans import corpus
from ..schemas import MESSAGES, SPLIT_LINE, USAGE
from ..sources import files, sync
from ..sources.files import cap_per_domain
from ..sources.fixed import EVAL_PROMPTS
from ..streaming import streams
from .tables import CODE, CODE_ROWS, code_rows, scratch, table


def _code_folder(spark: SparkSession, sf_dir: str) -> str:
    """Code as text files in five folders, and one folder of no source."""
    root = scratch(spark, "code")
    rows = code_rows(spark, sf_dir).selectExpr("code", "concat('d', id % 6) AS folder")
    rows.write.partitionBy("folder").text(root)
    return root


FOLDERS = [(f"folder=d{i}/", f"domain {i}", ["CAN bus"] * i) for i in range(5)]


def a2_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read from real files, by source: characters, functions' heads, contexts."""
    root = _code_folder(spark, sf_dir)
    read = files.with_source(files.read_code_files(spark, root), root, FOLDERS)
    heads = F.regexp_count("code", F.lit("static int fn_"))
    return read.groupBy("domain").agg(
        F.sum(F.length("code")).alias("chars"), F.sum(heads).cast("long").alias("heads"), F.max(F.size("contexts")).alias("n_contexts")
    )


A2 = f"""SELECT 'domain ' || (p_partkey % 6) AS domain, CAST(sum(length(code) + 1) AS BIGINT) AS chars, count(*) AS heads, CAST(max(p_partkey % 6) AS INT) AS n_contexts
FROM (SELECT p_partkey, {CODE} AS code FROM part) AS t WHERE p_partkey % 6 < 5 GROUP BY p_partkey % 6"""


def x1_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes below a prefix that is listed, by folder; markers have none."""
    listed = files.list_files(spark, _code_folder(spark, sf_dir))
    folder = F.regexp_extract("path", r"folder=(d\d)/[^/]*$", 1)
    return listed.filter("length > 0").groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))


X1P = f"""SELECT 'd' || (p_partkey % 6) AS folder, CAST(sum(strlen(code) + 1) AS BIGINT) AS bytes
FROM (SELECT p_partkey, {CODE} AS code FROM part) AS t GROUP BY p_partkey % 6"""


_BYTES = """CASE p_size % 3 WHEN 0 THEN concat('caf', chr(233), ' ', p_name, chr(13), chr(10), 'x')
  WHEN 1 THEN concat(p_name, chr(13), 'y') ELSE concat(p_name, chr(10)) END"""


def a3_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third text is stored as Latin-1, the others as UTF-8."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size", f"{_BYTES} AS text")
    content = F.when(F.col("p_size") % 3 == 0, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return rows.select("id", tf.decode_code(content).alias("code"))


A3 = f"SELECT p_partkey AS id, replace(replace({_BYTES}, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS code FROM part"


def a4_source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten files a source; names and suffixes are made from the id."""
    path = "concat(lpad(CAST(doc_id AS STRING), 12, '0'), CASE doc_id % 3 WHEN 0 THEN '.c' WHEN 1 THEN '.h' ELSE '.txt' END) AS path"
    rows = table(spark, sf_dir, "documents").selectExpr("source AS domain", path)
    return cap_per_domain(rows, 10)


A4 = """SELECT domain, path FROM (SELECT domain, path, row_number() OVER (PARTITION BY domain ORDER BY k, path) AS r FROM (
  SELECT source AS domain, doc_id % 3 AS k, concat(lpad(CAST(doc_id AS VARCHAR), 12, '0'), CASE doc_id % 3 WHEN 0 THEN '.c' WHEN 1 THEN '.h' ELSE '.txt' END) AS path
  FROM documents) AS t) AS u WHERE r <= 10"""


def a5_extract_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = code_rows(spark, sf_dir).withColumn("code", F.concat("code", F.lit("\nint tiny(void) { return 0; }\n"), F.lit("char* last(char *s) {\n"), "code"))
    found = examples.extract_functions(two.select("id", "code"))
    return found.select("id", "ordinal", "name", "return_type", "params", F.length("body").alias("n_body"), "lines", F.md5("body").alias("digest"))


#: The made code is one function; control heads inside it (a while after a tab or blank
#: has no word before it on its line but the one before) are found as the rule says.
A5 = rf"""WITH c AS (SELECT p_partkey AS id, p_size, {CODE} AS code FROM part),
one AS (SELECT id, p_size, code, substr(code, strpos(code, 'static int')) AS body FROM c),
f AS (
  SELECT id, 0 AS ordinal, 'fn_' || id AS name, 'int' AS return_type, 'int a, uint8_t vlan_id' AS params, rtrim(body, chr(10)) AS body FROM one
  UNION ALL
  SELECT id, 1, 'last', 'char*', 'char *s', 'char* last(char *s) {{' || chr(10) || code FROM one
  UNION ALL
  SELECT id, 2, 'fn_' || id, 'int', 'int a, uint8_t vlan_id', rtrim(body, chr(10)) FROM one)
SELECT id, CAST(ordinal AS INT) AS ordinal, name, return_type, params, CAST(length(body) AS INT) AS n_body,
  CAST(length(body) - length(replace(body, chr(10), '')) AS INT) AS lines, md5(body) AS digest FROM f"""


def a6_prompt_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.col("p_type").alias("ret"), F.col("p_name").alias("params"),
        F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.lit("CAN bus")).alias("context"),
    )
    choice = F.pmod(F.ascii(F.substring(F.md5(F.col("id").cast("string")), 1, 1)), F.lit(4))
    prompt = examples.function_prompt(F.col("name"), F.col("ret"), F.col("params"), F.col("context"), choice)
    return rows.select("id", prompt.alias("prompt"))


A6 = """WITH t AS (SELECT p_partkey AS id, p_brand AS name, p_type AS ret, p_name AS params,
  CASE WHEN p_size % 2 = 0 THEN '' ELSE 'CAN bus' END AS context, ascii(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 1)) % 4 AS k FROM part)
SELECT id, concat(CASE k WHEN 0 THEN concat('Generate a C function named ''', name, ''' that returns ', ret, ' with parameters (', params, ')')
  WHEN 1 THEN concat('Implement the function ''', name, ''' for automotive embedded systems')
  WHEN 2 THEN concat('Write C code for the ''', name, ''' function used in ', context)
  ELSE concat('Create an implementation of ''', name, ''' following automotive coding standards') END,
  CASE WHEN context <> '' THEN concat('. Context: ', context) ELSE '' END) AS prompt FROM t"""


def a6r_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded choices of a function's form and context."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(key.alias("id"), examples._pick(42, 4, key).alias("form"), examples._pick(43, 7, key, F.col("p_brand")).alias("context"))


A6R = """SELECT p_partkey AS id, CAST(CAST('0x' || substr(md5('42|' || p_partkey), 1, 8) AS BIGINT) % 4 AS INT) AS form,
  CAST(CAST('0x' || substr(md5('43|' || p_partkey || '|' || p_brand), 1, 8) AS BIGINT) % 7 AS INT) AS context FROM part"""


def a7_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").filter(F.length("text") > examples.MIN_COMPLETION)
    parts = rows.select("doc_id", examples.completion_parts(F.col("text")).alias("p")).filter("p is not null")
    return parts.select("doc_id", "p.split_at", F.md5("p.prefix").alias("prefix"), F.md5("p.suffix").alias("suffix"))


A7 = r"""WITH t AS (SELECT doc_id, string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10)) AS ls FROM documents WHERE length(text) > 200),
u AS (SELECT doc_id, ls, len(ls) AS n, CAST(floor(len(ls) * 0.5) AS INT) AS k FROM t)
SELECT doc_id, k AS split_at, md5(array_to_string(ls[1:k], chr(10))) AS prefix, md5(array_to_string(ls[k + 1:n], chr(10))) AS suffix
FROM u WHERE k >= 3 AND n - k >= 3"""


def a8_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many examples of each kind a domain gives; some files are empty or could not be read."""
    read = code_rows(spark, sf_dir).selectExpr(
        "concat('f', id) AS path", "concat('d', id % 5) AS domain", "array('CAN bus', 'LIN bus') AS contexts",
        "CASE id % 11 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE code END AS code",
    )
    made = examples.training_examples(read)
    kind = F.coalesce("metadata.type", F.lit("function"))
    return made.groupBy(F.col("metadata.domain").alias("domain"), kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.col("messages")[1]["content"])).cast("long").alias("answer_chars")
    )


A8 = rf"""WITH c AS (SELECT 'd' || (p_partkey % 5) AS domain, {CODE} AS code FROM part WHERE p_partkey % 11 > 1),
f AS (SELECT domain, 'function' AS kind, length(rtrim(substr(code, strpos(code, 'static int')), chr(10))) AS n FROM c),
g AS (SELECT domain, string_split(regexp_replace(code, '^\s+|\s+$', '', 'g'), chr(10)) AS ls FROM c WHERE length(code) > 200),
h AS (SELECT domain, 'code_completion' AS kind, length(array_to_string(ls[CAST(floor(len(ls) * 0.5) AS INT) + 1:len(ls)], chr(10))) + 9 AS n FROM g
  WHERE floor(len(ls) * 0.5) >= 3 AND len(ls) - floor(len(ls) * 0.5) >= 3)
SELECT domain, kind, count(*) AS n, CAST(sum(n) AS BIGINT) AS answer_chars FROM (SELECT * FROM f UNION ALL SELECT * FROM h) AS t GROUP BY domain, kind"""


def a9_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "source").withColumn("digest", F.md5("text"))
    return splits.deduplicate(rows.drop("text"), ["digest"], ["doc_id"])


A9 = "SELECT doc_id, source, md5(text) AS digest FROM documents d WHERE doc_id = (SELECT min(doc_id) FROM documents e WHERE e.text = d.text)"


def a9_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.exact_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")


A9X = """SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents"""


def a9_written_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of written splits in the order of files and lines."""
    folder = scratch(spark, "shuffled")
    named = _messages(spark, sf_dir).withColumn("split", F.when(F.col("conv_id") % 10 == 0, "val").otherwise("train"))
    corpus.write(named, folder, key=F.col("conv_id"))
    read = [
        files.lines_in_order(spark, f"{folder}/{split}.jsonl").select(F.lit(split).alias("split"), "place", F.from_json("value", SPLIT_LINE).getField("messages").alias("messages"))
        for split in ("train", "val")
    ]
    both = read[0].unionByName(read[1])
    first = F.element_at("messages", 1)
    return both.select("split", "place", F.size("messages").alias("n"), F.md5(F.concat(first["role"], F.lit(":"), first["content"])).alias("digest"))


A9W = """SELECT split, row_number() OVER (PARTITION BY split ORDER BY md5('42|' || conv_id)) - 1 AS place, n, digest FROM (
  SELECT conv_id, CASE WHEN conv_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, CAST(count(*) AS INT) AS n,
    md5(arg_min(role, turn) || ':' || arg_min(text, turn)) AS digest FROM conversations GROUP BY conv_id) AS t"""


def a1_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code files copied to a new folder, then again after some are gone from it and one has another size."""
    root = _code_folder(spark, sf_dir)
    target, reports = scratch(spark, "target"), scratch(spark, "reports")
    first = sync.sync(spark, _uri(root), _uri(target), f"{reports}/first", 4)
    # What the target lacks afterwards: all of one folder.
    held = sync.listing(spark, _uri(target)).filter(~F.col("path").startswith("folder=d3/"))
    again = sync.outdated(sync.listing(spark, _uri(root)), held)
    parts = [
        first.filter("error is null").select(F.lit("copied").alias("what"), "path", "length"),
        again.select(F.lit("outdated").alias("what"), "path", "length"),
        sync.outdated(sync.listing(spark, _uri(root)), sync.listing(spark, _uri(target))).select(F.lit("left").alias("what"), "path", "length"),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    code = rows.filter("path like 'folder=%' and path not like '%.crc'").groupBy("what", F.split_part("path", F.lit("/"), F.lit(1)).alias("folder"))
    return code.agg(F.sum("length").cast("long").alias("bytes"))


def _uri(path: str) -> str:
    return path if ":" in path else f"file://{path}"


A1 = f"""WITH c AS (SELECT 'folder=d' || id % 6 AS folder, CAST(sum(strlen(code) + 1) AS BIGINT) AS bytes FROM ({CODE_ROWS}) AS t GROUP BY id % 6)
SELECT 'copied' AS what, folder, bytes FROM c UNION ALL SELECT 'outdated', folder, bytes FROM c WHERE folder = 'folder=d3'"""


def a9_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = table(spark, sf_dir, "documents").select(F.struct(F.col("source").alias("domain")).alias("metadata"))
    return corpus.domain_counts(examples)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    return grouped.select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).cast(MESSAGES).alias("messages"))


def _split_folder(spark: SparkSession, sf_dir: str) -> str:
    """Conversations as written splits: every tenth for validation."""
    folder = scratch(spark, "splits")
    named = _messages(spark, sf_dir).withColumn("split", F.when(F.col("conv_id") % 10 == 0, "val").otherwise("train"))
    corpus.write(named, folder)
    return folder


def _digests(rows: DataFrame) -> DataFrame:
    m = F.col("messages")
    return rows.select(F.size(m).alias("n"), F.md5(F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "\n")).alias("digest"))


def a10_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training split as it is written and read again."""
    return _digests(files.read_split(spark, f"{_split_folder(spark, sf_dir)}/train.jsonl"))


def x5_cached_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No splits where nothing is written, both where they are."""
    found = files.cached_splits(spark, scratch(spark, "nothing"))
    assert found is None
    train, val = files.cached_splits(spark, _split_folder(spark, sf_dir))
    return _digests(train).withColumn("split", F.lit("train")).unionByName(_digests(val).withColumn("split", F.lit("val")))


def e2_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without splits and prompts: accumulated corrections, and the built-in prompts."""
    out = scratch(spark, "run")
    fixed = _messages(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("id"), F.lit("p").alias("original_prompt"), F.lit("o").alias("student_output"), F.lit(1.0).alias("student_score"),
        F.lit("t").alias("teacher_correction"), F.lit(1).alias("epoch"), "messages", F.lit(None).cast(USAGE).alias("usage"),
    )
    for epoch in (1, 2):
        files.write_corrections(fixed.filter(F.col("id") % 2 == epoch - 1), f"{out}/corrections", epoch)
    train, prompts = files.load_datasets(spark, f"{out}/train", out, f"{out}/eval")
    asked = prompts.select(F.lit(0).alias("n"), F.md5(F.concat("id", F.lit(":"), "prompt")).alias("digest"))
    return _digests(train).unionByName(asked)


def e3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select("conv_id", tf.render_chat(F.col("messages")).alias("chat"))


def e4_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with some roles and contents taken away."""
    broken = F.when(F.col("conv_id") % 7 == 0, F.lit(None).cast(MESSAGES)).when(
        F.col("conv_id") % 5 == 0, F.transform("messages", lambda m: F.struct(F.lit(None).cast("string").alias("role"), m["content"].alias("content")))
    ).otherwise(F.col("messages"))
    return monitor.validate_messages(_messages(spark, sf_dir).select(broken.alias("messages")))


E4 = """WITH c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE conv_id % 7 = 0) AS no_messages,
  count(*) FILTER (WHERE conv_id % 7 <> 0 AND conv_id % 5 = 0) AS no_role, CAST(0 AS BIGINT) AS no_content FROM c"""


def e10_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tf.first_tokens(F.col("text"), 32).alias("head"))


def g2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tf.token_count(F.col("text")).alias("token_count"))


def t1_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of the benchmark's texts that equal a line of a document."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    items = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n")).alias("line"))
    return splits.shared_rows(lines, items, F.md5("line")).select("doc_id", F.md5("line").alias("digest")).distinct()


T1 = """SELECT DISTINCT doc_id, md5(line) AS digest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) AS d
WHERE line IN (SELECT unnest(string_split(text, chr(10))) FROM benchmark)"""


def t2_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that both halves of the corpus hold, by digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    left, right = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    return splits.shared_rows(left.select("digest"), right, "digest").distinct()


def t3_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns that hold the whole turn before them; every third is given it, in lower case if odd."""
    turns = table(spark, sf_dir, "conversations")
    users = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    pairs = turns.filter("role = 'assistant'").join(users, ["conv_id", "turn"])
    echo = F.when(F.col("conv_id") % 6 == 0, F.col("prompt")).when(F.col("conv_id") % 6 == 3, F.lower("prompt")).otherwise(F.lit(""))
    told = pairs.select("conv_id", "turn", "prompt", F.concat("text", F.lit(" "), echo).alias("response"))
    return splits.prompt_in_response(told).select("conv_id", "turn", "prompt")


T3 = """SELECT conv_id, turn, prompt FROM (SELECT a.conv_id, a.turn, u.text AS prompt,
  a.text || ' ' || CASE a.conv_id % 6 WHEN 0 THEN u.text WHEN 3 THEN lower(u.text) ELSE '' END AS response
  FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE a.role = 'assistant') AS t WHERE contains(response, prompt)"""


def a9e_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts by the stateful form, over the table as a stream."""
    docs = table(spark, sf_dir, "documents")
    # A stream reads folders; the table may be one file.
    at = scratch(spark, "stream")
    docs.select(F.col("text").alias("value")).write.parquet(f"{at}/in")
    stream = spark.readStream.schema("value string").parquet(f"{at}/in")
    streams.append_to(streams.dedup_lines(stream).select("digest"), f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.schema("digest string").json(f"{at}/out")


def a9e_store_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts over the table as a stream that ends and goes on with more files."""
    docs, at = table(spark, sf_dir, "documents"), scratch(spark, "stream")
    for part in (0, 1):
        docs.filter(F.col("doc_id") % 2 == part).select(F.col("text").alias("value")).write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).parquet(f"{at}/in")
        streams.store_once(stream, f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.schema("digest string").parquet(f"{at}/out").select("digest")


def x4_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("split"), "text")
    wanted = spark.sql("SELECT * FROM VALUES ('en'), ('de'), ('fr'), ('es'), ('none') AS t(split)")
    return manifest.line_counts(docs, wanted)


X4 = """SELECT s.split, CAST(coalesce(sum(length(d.text) - length(replace(d.text, chr(10), '')) + 1) FILTER (WHERE length(d.text) > 0), 0) AS BIGINT) AS n_lines
FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('none')) AS s(split) LEFT JOIN documents d ON d.lang = s.split GROUP BY s.split"""

A10 = "SELECT CAST(count(*) AS INT) AS n, md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS digest FROM conversations WHERE conv_id % 10 <> 0 GROUP BY conv_id"
_EVAL = ", ".join("('" + f"{i}:{p}".replace("'", "''") + "')" for i, p in EVAL_PROMPTS)

QUERIES = {f.__name__: f for f in (
    a2_files, a3_decode, a4_source_cap, a5_extract_functions, a6_prompt_template, a6r_choice, a7_completion, a8_examples, a9_dedup,
    a1_sync, a9_split, a9_written_order, a9e_store_once, a9_domain_counts, a10_messages, e3_chat, e4_validate, e10_truncate, g2_token_count, t1_leakage, t2_intersection,
    t3_contains, x4_line_counts, x1_prefix, x5_cached_splits, e2_fallback, a9e_stream_dedup,
)}
ORACLES = {
    "a2_files": A2,
    "x1_prefix": X1P,
    "x5_cached_splits": f"SELECT *, 'train' AS split FROM ({A10}) AS t UNION ALL SELECT *, 'val' FROM ({A10.replace('<> 0', '= 0')}) AS v",
    "e2_fallback": f"SELECT n, digest FROM ({A10.replace('WHERE conv_id % 10 <> 0', '')}) AS t UNION ALL SELECT 0, md5(x) FROM (VALUES {_EVAL}) AS v(x)",
    "a9e_stream_dedup": "SELECT DISTINCT md5(text) AS digest FROM documents",
    "a3_decode": A3,
    "a4_source_cap": A4,
    "a5_extract_functions": A5,
    "a6_prompt_template": A6,
    "a6r_choice": A6R,
    "a7_completion": A7,
    "a8_examples": A8,
    "a9_dedup": A9,
    "a9_split": A9X,
    "a1_sync": A1,
    "a9_written_order": A9W,
    "a9e_store_once": "SELECT DISTINCT md5(text) AS digest FROM documents",
    "a9_domain_counts": "SELECT source AS domain, count(*) AS n FROM documents GROUP BY source",
    "a10_messages": A10,
    "e3_chat": "SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn) AS chat FROM conversations WHERE role IN ('user', 'assistant', 'system') GROUP BY conv_id",
    "e4_validate": E4,
    "e10_truncate": "SELECT doc_id, array_to_string(string_split(text, ' ')[1:32], ' ') AS head FROM documents",
    "g2_token_count": r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT) AS token_count FROM documents",
    "t1_leakage": T1,
    "t2_intersection": "SELECT md5(text) AS digest FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT md5(text) FROM documents WHERE doc_id % 2 = 1",
    "t3_contains": T3,
    "x4_line_counts": X4,
}
