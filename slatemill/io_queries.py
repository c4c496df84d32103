"""Queries that go through sources, sinks and streams and come back: what was written is read again."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.catalog_queries import _COVERAGE, _PREDICTED, _RATES, _coverage, _scored
from slatemill.operators import evaluation as E
from slatemill.operators import lookup as L
from slatemill.operators.ordered import numbered
from slatemill.plans.cut import remove_at_exit, shared_dir
from slatemill.registry import query
from slatemill.sources import files, sinks
from slatemill.sources.tables import read
from slatemill.streaming import outbox


def _folder(spark: SparkSession) -> str:
    path = f"{shared_dir(spark)}/slatemill-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


def _literal(spark: SparkSession, text: str, path: str) -> str:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


@query("""WITH p AS (SELECT DISTINCT prediction_id, test_question_id, question_id, file, pos FROM predictions) SELECT file, count(*) AS n, count(test_question_id) AS n_asked, count(DISTINCT coalesce(test_question_id, question_id)) AS n_questions FROM p GROUP BY 1""")
def chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """Predictions written as chunk files and scanned again, each row with its file."""
    path = _folder(spark)
    rows = read(spark, d, "predictions", "prediction_id", "test_question_id", "question_id", F.col("file").alias("origin"), "pos").distinct().withColumn("part", F.col("origin"))
    sinks.write_prediction_chunks(rows, "part", ["pos", "prediction_id"], path)
    back = files.prediction_chunks(spark, f"{path}/part=*/*.txt", "prediction_id string, test_question_id string, question_id string, origin string")
    return back.groupBy(F.col("origin").alias("file")).agg(F.count("*").alias("n"), F.count("test_question_id").alias("n_asked"), F.count_distinct(F.coalesce("test_question_id", "question_id")).alias("n_questions"))


@query("SELECT DISTINCT lesson_id, title, grade FROM lesson")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lessons written as one JSON array a file with a byte order mark and read as whole documents; a missing file adds nothing."""
    rows = read(spark, d, "lesson", "lesson_id", "title", "grade").distinct()
    texts = numbered(rows, ["lesson_id"]).groupBy(F.floor(F.col("row_no") / 500).alias("f")).agg(F.concat(F.lit("﻿"), F.to_json(F.collect_list(F.struct("lesson_id", "title", "grade")))).alias("value"))
    path = _folder(spark)
    texts.write.partitionBy("f").text(path)
    schema = "lesson_id string, title string, grade string"
    return files.json_documents(spark, f"{path}/f=*/*.txt", schema).select("lesson_id", "title", "grade").unionByName(files.json_documents(spark, f"{path}/missing.json", schema))


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def assigned_scripts(spark: SparkSession, d: str) -> DataFrame:
    """Objects read out of scripts that assign them, without running them."""
    rows = read(spark, d, "events", "event_id", "props").select("event_id", F.concat(F.lit("window.WORKBENCH_DATA = "), "props", F.lit(";\n")).alias("js"))
    return files.assigned_json(rows, "js", "k long").select("event_id", "data.k")


@query("SELECT * FROM (VALUES ('name', 'slate mill'), ('limits.queue', '8'), ('limits.strict', 'true'), ('formats', 'docx,pdf'), ('ratio', '0.5')) AS t(key, value)")
def configuration(spark: SparkSession, d: str) -> DataFrame:
    """A configuration file in the small subset of YAML, flattened."""
    path = _literal(spark, "name: 'slate mill'  # title\nlimits:\n  queue: 8\n  strict: true\nformats:\n  - docx\n  - pdf\nratio: 0.5\n", _folder(spark))
    text = spark.read.text(path, wholetext=True).first()[0]
    flat = []
    for key, value in files.small_yaml(text).items():
        for name, x in [(f"{key}.{k}", v) for k, v in value.items()] if isinstance(value, dict) else [(key, value)]:
            flat.append((name, ",".join(x) if isinstance(x, list) else str(x).lower() if isinstance(x, bool) else str(x)))
    return spark.createDataFrame(flat, "key string, value string")


@query("SELECT subject, 'ok' AS status, count(DISTINCT lesson_id)::INT AS pages, 'h_' || subject AS header, subject || '.pdf' AS path FROM lesson GROUP BY subject")
def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """A tab-separated manifest without header, written and read."""
    path = _folder(spark)
    counts = read(spark, d, "lesson", "lesson_id", "subject").groupBy("subject").agg(F.count_distinct("lesson_id").alias("n"))
    counts.select("subject", F.lit("ok"), F.concat(F.lit("pages="), F.col("n").cast("string")), F.concat(F.lit("header=h_"), "subject"), F.lit("visual=v"), F.concat("subject", F.lit(".pdf"))).write.option("sep", "\t").csv(path)
    return files.manifest(spark, path).select("subject", "status", "pages", "header", "path")


@query("SELECT 'icon_' || r_regionkey AS key, r_name AS name FROM region")
def icon_manifests(spark: SparkSession, d: str) -> DataFrame:
    """A JSON manifest of named entries."""
    rows = read(spark, d, "region", "r_regionkey", "r_name")
    entries = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("icon_"), F.col("r_regionkey").cast("string")), F.struct(F.col("r_name").alias("name")))))
    path = _folder(spark)
    rows.agg(F.to_json(F.struct(entries.alias("icons"))).alias("value")).coalesce(1).write.text(path)
    return files.icon_manifest(spark, f"{path}/*.txt").select("key", F.get_json_object("entry", "$.name").alias("name"))


@query("SELECT 'v00000002' AS version, status, count(DISTINCT lesson_id) AS n FROM lesson WHERE status = 'published' GROUP BY ALL")
def stored_versions(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots one after the other, the second over the version that it was made from; readers see the last."""
    root = _folder(spark)
    lessons = read(spark, d, "lesson", "lesson_id", "status").distinct()
    first = sinks.snapshot({"lesson": lessons}, root)
    sinks.snapshot({"lesson": lessons.filter("status = 'published'")}, root, expected=first)
    return sinks.read_snapshot(spark, root, "lesson").groupBy(F.lit(sinks.current(spark, root)).alias("version"), "status").agg(F.count_distinct("lesson_id").alias("n"))


@query("SELECT 'nation' AS sheet, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'empty', 0")
def sheet_files(spark: SparkSession, d: str) -> DataFrame:
    """One folder a sheet, also of an empty one, read again."""
    path = _folder(spark)
    tables = {"nation": read(spark, d, "nation"), "region": read(spark, d, "region"), "empty": read(spark, d, "region").limit(0)}
    sinks.sheets(tables, path)
    out = None
    for name, df in tables.items():
        part = spark.read.option("header", True).schema(df.schema).csv(f"{path}/{name}").agg(F.lit(name).alias("sheet"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 30")
def capped_history(spark: SparkSession, d: str) -> DataFrame:
    """The thirty latest entries of a history after new ones came to it."""
    rows = read(spark, d, "events", "event_id", "ts")
    return sinks.history(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), "ts")


@query(f"WITH {_COVERAGE}, {_PREDICTED}, r AS (SELECT {_RATES} FROM scored), l AS (SELECT 1 AS line_no, '# 落位' AS line UNION ALL SELECT 2, '' UNION ALL SELECT 3, '## 总体' UNION ALL SELECT 4, '' UNION ALL SELECT 5, '| n_questions | n_predicted |' UNION ALL SELECT 6, '|---|---|' UNION ALL SELECT 7, '| ' || n_questions || ' | ' || n_predicted || ' |' FROM r) SELECT line_no, line FROM l")
def evaluation_report(spark: SparkSession, d: str) -> DataFrame:
    """The report of an evaluation, line by line."""
    lines = sinks.report_lines("落位", [("总体", E.rates(_scored(spark, d)), ["n_questions", "n_predicted"])])
    return spark.createDataFrame([*enumerate(lines, 1)], "line_no int, line string")


@query("""WITH l AS (SELECT DISTINCT lesson_id, status FROM lesson), k AS (SELECT lesson_id, CASE WHEN status = 'published' THEN 'deleted' ELSE status END AS status FROM l WHERE lesson_id LIKE 'math%' UNION ALL SELECT 'new_lesson', 'created') SELECT lesson_id, status FROM k UNION ALL SELECT * FROM l WHERE lesson_id NOT IN (SELECT lesson_id FROM k)""")
def merged_lessons(spark: SparkSession, d: str) -> DataFrame:
    """A keyed merge: changed rows in place of those they change, new ones added."""
    from slatemill.operators.store import upsert

    lessons = read(spark, d, "lesson", "lesson_id", "status").distinct()
    changes = lessons.filter("lesson_id like 'math%'").withColumn("status", F.when(F.col("status") == "published", "deleted").otherwise(F.col("status"))).unionByName(spark.createDataFrame([("new_lesson", "created")], "lesson_id string, status string"))
    return upsert(lessons, changes, ["lesson_id"])


@query("""WITH v(vn, version) AS (VALUES (1, '常用版'), (2, '基础版'), (3, '进阶版')), a(audience) AS (VALUES ('student'), ('teacher')), f(format) AS (VALUES ('docx'), ('pdf')), q AS (SELECT DISTINCT question_id, group_id, component_kind AS k FROM split_questions), t AS (SELECT question_id, group_id, version FROM q, v WHERE vn = 1 OR (vn = 2 AND k IN ('example', 'after_class')) OR (vn = 3 AND k = 'advanced'))
SELECT group_id, version, audience, format, count(*) AS n_questions FROM t, a, f GROUP BY ALL""")
def selection_manifest(spark: SparkSession, d: str) -> DataFrame:
    """What each exported file of a group holds: versions, audiences and formats with their numbers of questions."""
    rows = read(spark, d, "split_questions", "question_id", "group_id", "component_kind").distinct()
    kind = F.col("component_kind")
    versions = F.array_compact(F.array(F.lit("常用版"), F.when(kind.isin("example", "after_class"), "基础版"), F.when(kind == "advanced", "进阶版")))
    counts = rows.select("group_id", F.explode(versions).alias("version")).groupBy("group_id", "version").agg(F.count("*").alias("n_questions"))
    cells = [F.struct(F.lit(a).alias("audience"), F.lit(f).alias("format")) for a in ("student", "teacher") for f in ("docx", "pdf")]
    return counts.select("group_id", "version", "n_questions", F.explode(F.array(*cells)).alias("x")).select("group_id", "version", "x.*", "n_questions")


@query("""WITH q AS (SELECT DISTINCT question_id, visual_pages AS p FROM split_questions), i AS (SELECT DISTINCT u.x.page AS page, u.x.parent_segment_id AS img FROM split_questions, unnest(fragments) AS u(x)), e AS (SELECT question_id, unnest(p) AS page, generate_subscripts(p, 1) AS k FROM q)
SELECT question_id, string_agg(img, ',' ORDER BY k, img) AS images, count(*) AS n FROM e JOIN i USING (page) GROUP BY 1""")
def question_images(spark: SparkSession, d: str) -> DataFrame:
    """The pictures of each question in the order of its pages."""
    rows = read(spark, d, "split_questions", "question_id", "visual_pages", "fragments")
    pictures = rows.select(F.explode("fragments").alias("x")).select("x.page", F.col("x.parent_segment_id").alias("img")).distinct()
    return L.in_order(rows.select("question_id", "visual_pages").distinct(), "question_id", "visual_pages", pictures, "page", "img").select("question_id", F.array_join("items", ",").alias("images"), F.size("items").cast("long").alias("n"))


@query(f"""WITH {_COVERAGE}, l AS (SELECT lesson_id, list_sort(list(test_question_id)) AS ids FROM c WHERE test_question_id LIKE '%7' GROUP BY 1), e AS (SELECT lesson_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS place FROM l) SELECT e.lesson_id, place, e.id AS test_question_id, c.status FROM e JOIN c ON c.test_question_id = e.id""")
def listed_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions named in lists, in the order of the list; every id must have its row."""
    rows = _coverage(spark, d).select("test_question_id", "status", "lesson_id")
    wanted = rows.filter("test_question_id like '%7'")
    lists = wanted.groupBy("lesson_id").agg(F.array_sort(F.collect_list("test_question_id")).alias("ids"))
    known = L.strict_lookup(wanted.select("test_question_id"), rows.select("test_question_id", "status"), "test_question_id")
    return L.ordered_lookup(lists, "ids", known, "test_question_id").select("lesson_id", "place", "test_question_id", "status")


@query("SELECT user_id, count(*) AS n_events FROM events GROUP BY 1")
def staged_counts(spark: SparkSession, d: str) -> DataFrame:
    """A stage that is made once and read from its folder when asked for again."""
    root = _folder(spark)
    make = lambda: read(spark, d, "events", "user_id").groupBy("user_id").agg(F.count("*").alias("n_events"))
    L.stage(root, "counts", "1", make)
    return L.stage(root, "counts", "1", lambda: make().limit(0))


# ---------------------------------------------------------------- streams


def _ran(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream writes until its source is used up."""
    path = _folder(spark)
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    else:
        write = lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out")
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _log(spark: SparkSession, d: str) -> DataFrame:
    """The event log as an append-only folder."""
    path = _folder(spark)
    read(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value").write.parquet(path)
    return outbox.event_stream(spark, path, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n_events FROM events GROUP BY ALL")
def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts as a stream gives them."""
    counts = _ran(spark, outbox.window_counts(_log(spark, d), "1 day", "1 hour"), "complete")
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def streamed_once(spark: SparkSession, d: str) -> DataFrame:
    """Each event once, though the log delivers it twice."""
    log = _log(spark, d)
    return _ran(spark, outbox.deduplicated(log.unionByName(log), "event_id", "60 days")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, max(ts) AS last_beat, 'retry_wait' AS status FROM events GROUP BY 1 HAVING max(ts) + INTERVAL 12 HOUR < (SELECT max(ts) FROM events) - INTERVAL 1 SECOND")
def streamed_stalls(spark: SparkSession, d: str) -> DataFrame:
    """Producers whose heartbeat stops while the log goes on, as a stream with timers tells them."""
    out = _ran(spark, outbox.stalled_stream(_log(spark, d).select("user_id", "ts"), "user_id", 12 * 3_600_000, "1 second"))
    last = out.groupBy("user_id", "status").agg(F.max("last_beat").alias("last_beat"))
    return last.select("user_id", F.col("last_beat").cast("timestamp_ntz").alias("last_beat"), "status")
