"""All queries of the engine by name, each with SQL for DuckDB that gives the same rows.

The tables hold plain conversations, so tagged, labelled, repeated and empty records are made
from them inside each query, alike in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import prompts, text
from ..operators import merge, multilang, rollout, sampling

#: (value, weight) of the draws that the queries make.
MOODS = [("calm", 5), ("brisk", 3), ("wry", 1), ("tender", 7), ("stern", 4)]
TIES = [("met on {platform}", 4), ("neighbours", 6), ("both follow {fandom}", 3), ("met in {community}", 2), ("play {gaming}", 2), ("cousins", 3)]
PICKS = {"platform": ["Harbor", "Lantern", "Quill"], "community": ["a choir", "a garden club"], "fandom": ["old radio plays", "silent films"], "gaming": ["chess online", "a racing league", "trivia nights"]}

_U = "(({id} * 7919) % 10007) / CAST(10007 AS DOUBLE)"
_BL = "'" + "".join(text.BLANKS).replace("'", "''") + "'"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _inline(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join("(" + ", ".join(repr(v) if not isinstance(v, str) else "'" + v.replace("'", "\\'") + "'" for v in r) + ")" for r in rows) + f" AS t({names})")


def _values(rows: list[tuple], names: str) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(repr(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows) + f") AS t({names}))"


QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


# --- assembling and merging ------------------------------------------------------------------------------------

def _assembled(spark, sf_dir):
    """A chat of each conversation: a part for each turn, its messages the text's lines that aren't blank."""
    lines = F.filter(F.split("text", "\n"), lambda m: text.strip(m) != "")
    part = F.struct("turn", F.col("role").alias("sender"), lines.alias("messages"))
    chats = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("chat_parts"))
    return chats.withColumn("chat_parts", F.transform("chat_parts", lambda p: F.struct(p["sender"].alias("sender"), p["messages"].alias("messages"))))


@query("""SELECT conv_id, CAST(count(*) AS INTEGER) AS turns, CAST(sum(len(list_filter(string_split(text, chr(10)), lambda x: trim(x, %s) <> ''))) AS INTEGER) AS messages,
  arg_min(role, turn) AS first_sender, arg_max(role, turn) AS last_sender FROM conversations GROUP BY conv_id""" % _BL)
def chat_assemble(spark, sf_dir):
    turns, messages = merge.chat_sizes(F.col("chat_parts"))
    senders = F.transform("chat_parts", lambda p: p["sender"])
    return _assembled(spark, sf_dir).select("conv_id", turns.alias("turns"), messages.alias("messages"), F.element_at(senders, 1).alias("first_sender"), F.element_at(senders, -1).alias("last_sender"))


_RECORDS = """records AS (SELECT conv_id AS pos, CASE WHEN conv_id % 13 = 5 THEN NULL ELSE 'c' || CAST(conv_id // 2 AS VARCHAR) END AS chat_id,
  CASE WHEN conv_id % 7 = 0 THEN 0 WHEN conv_id % 7 = 1 THEN 1 ELSE count(*) END AS n FROM conversations GROUP BY conv_id),
firsts AS (SELECT *, min(CASE WHEN n >= 2 THEN pos END) OVER (PARTITION BY chat_id) AS f FROM records),
marked AS (SELECT pos, chat_id, n, CASE WHEN chat_id IS NULL THEN 'malformed' WHEN pos = f THEN 'written' WHEN pos > f THEN 'duplicate' ELSE 'empty' END AS status FROM firsts)"""


def _records(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("pos")).agg(F.count("*").alias("turns"))
    n = F.when(F.col("pos") % 7 == 0, 0).when(F.col("pos") % 7 == 1, 1).otherwise(F.col("turns"))
    rows = rows.select("pos", F.when(F.col("pos") % 13 != 5, F.concat(F.lit("c"), F.expr("pos div 2").cast("string"))).alias("chat_id"), n.cast("long").alias("n"))
    return merge.keep_first(rows, "chat_id", ["pos"], F.col("n") >= 2)


@query(f"WITH {_RECORDS} SELECT status, count(*) AS n FROM marked GROUP BY status")
def merge_status(spark, sf_dir):
    return _records(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {_RECORDS} SELECT chat_id, pos FROM marked WHERE status = 'written'")
def merge_written(spark, sf_dir):
    return _records(spark, sf_dir).filter("status = 'written'").select("chat_id", "pos")


@query("SELECT conv_id, CAST(count(*) AS INTEGER) AS turns FROM conversations GROUP BY conv_id HAVING count(*) >= 2")
def min_turns(spark, sf_dir):
    """Chats written as JSON lines and classified: those of two turns or more are accepted."""
    value = F.to_json(F.struct(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("chat_id"), "chat_parts"), prompts.JSON)
    lines = _assembled(spark, sf_dir).select(F.lit("f").alias("file"), F.col("conv_id").alias("line"), value.alias("value"))
    return merge.merge_chats(lines)[1].filter("status = 'written'").select(F.col("line").alias("conv_id"), "turns")


# Lines of every odd kind, and what becomes of each: (chat_id as JSON, experience, parts, status, cleaned parts).
_PEOPLE = '{"persona1":{"name":"Ann","username":null},"persona2":{"name":"Bob","username":"bee"}}'
_TALK = '[{"sender":"a","messages":["Ann: hi"]},{"sender":"b","messages":["so <delay/> bee: ok"]}]'
_CLEAN_TALK = '[{"sender":"a","messages":["hi"]},{"sender":"b","messages":["so","<delay/>","ok"]}]'
_ODD = [
    ('"k1"', _PEOPLE, _TALK, "written", _CLEAN_TALK), ('"0"', _PEOPLE, _TALK, "written", _CLEAN_TALK), ('"false"', _PEOPLE, _TALK, "written", _CLEAN_TALK),
    ("5", _PEOPLE, _TALK, "written", _CLEAN_TALK), ('"5"', _PEOPLE, _TALK, "written", _CLEAN_TALK), ("0", _PEOPLE, _TALK, "malformed", None),
    ("false", _PEOPLE, _TALK, "malformed", None), ("null", _PEOPLE, _TALK, "malformed", None), ('""', _PEOPLE, _TALK, "malformed", None), ("[]", _PEOPLE, _TALK, "malformed", None),
    ('"k2"', '{"persona1":{},"persona2":{"name":"Bob"}}', _TALK, "written", _TALK), ('"k3"', '{"persona2":{"name":"Bob"}}', _TALK, "written", _TALK),
    ('"k4"', _PEOPLE, '[{"sender":"a","messages":["Ann: hi",null,7,"x"]},{"sender":"b","messages":[]}]', "written", '[{"sender":"a","messages":["hi",null,7,"x"]},{"sender":"b","messages":[]}]'),
    ('"k5"', _PEOPLE, "[1,2]", "error", None), ('"k5"', _PEOPLE, '{"a":1}', "empty", None), ('"k5"', _PEOPLE, '[{"sender":"a","messages":["hi"]}]', "empty", None), ('"k1"', _PEOPLE, "[3,4]", "duplicate", None),
]


def _odd_values() -> str:
    said = lambda x: "CAST(NULL AS VARCHAR)" if x is None else "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join(f"({k}, {', '.join(map(said, row))})" for k, row in enumerate(_ODD)) + ")"


@query(f"""WITH o(k, id, experience, parts, status, cleaned) AS {_odd_values()}, c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT CAST(conv_id * 100 + k AS BIGINT) AS line, status, CASE WHEN status = 'written' THEN id END AS chat_id, CASE WHEN status = 'written' THEN cleaned END AS parts FROM c, o WHERE c.conv_id = (SELECT min(conv_id) FROM conversations)
UNION ALL SELECT CAST(conv_id * 100 + k AS BIGINT), CASE WHEN status = 'written' THEN 'duplicate' ELSE status END, NULL, NULL FROM c, o WHERE c.conv_id > (SELECT min(conv_id) FROM conversations)""")
def merge_odd(spark, sf_dir):
    """Records of odd shapes, repeated once for each conversation: null and numeric messages, empty personas, ids of every type, parts that aren't objects."""
    convs = _read(spark, sf_dir, "conversations").select("conv_id").distinct()
    values = ['{"chat_id":%s,"experience":%s,"chat_parts":%s}' % row[:3] for row in _ODD]
    rows = convs.select("conv_id", F.posexplode(F.array(*map(F.lit, values))).alias("k", "value"))
    marked = merge.merge_chats(rows.select(F.lit("f").alias("file"), (F.col("conv_id") * 100 + F.col("k")).alias("line"), "value"))[1]
    done = merge.cleaned(marked.withColumn("value", F.when(F.col("status") == "written", F.col("value"))))
    return done.select("line", "status", F.to_json("chat_id").alias("chat_id"), F.to_json("chat_parts", prompts.JSON).alias("parts"))


# --- names and tags --------------------------------------------------------------------------------------------

_LABELLED = """CASE turn % 5 WHEN 0 THEN role || ': ' || text WHEN 1 THEN upper(role) || ':' || text || '  ' WHEN 2 THEN '  ' || role || ' :' || text
  WHEN 3 THEN '@' || role || 'x: ' || text || ' then ' || role || ': end' ELSE role || ' ' || text END"""


def _scrub_sql(message: str, names: list[str], users: list[str]) -> str:
    for n in names:
        for search in (f"{n} || ':'", f"lower({n}) || ':'", f"upper({n}) || ':'", f"{n} || ' :'", f"' ' || {n} || ':'"):
            message = f"replace({message}, {search}, '')"
    for u in users:
        for search in (f"{u} || ':'", f"'@' || {u} || ':'"):
            message = f"replace({message}, {search}, '')"
    return message


@query(f"""WITH a AS (SELECT conv_id, turn, role, {_LABELLED} AS m FROM conversations),
b AS (SELECT conv_id, turn, role, trim({_scrub_sql('m', ["role", "'Zed'"], ["role || 'x'"])}, {_BL}) AS m FROM a),
c AS (SELECT conv_id, turn, trim(CASE WHEN starts_with(m, role) THEN substr(m, length(role) + 1) ELSE m END, {_BL}) AS m FROM b)
SELECT conv_id, turn, md5(CASE WHEN starts_with(m, 'Zed') THEN trim(substr(m, 4), {_BL}) ELSE m END) AS digest FROM c""")
def name_scrub(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations").withColumn("m", F.expr(_LABELLED.replace("VARCHAR", "STRING")))
    cleaned = text.scrub_names(F.col("m"), [F.col("role"), F.lit("Zed")], [F.concat("role", F.lit("x")), F.lit(None).cast("string")])
    return rows.select("conv_id", "turn", F.md5(cleaned).alias("digest"))


_TAGGED = {
    "tag_split_hard": ("substr(text, 1, 12) || ' <delay minutes=\"5\"/> ' || substr(text, 13, 20) || '<audio>hum</audio>' || substr(text, 33)", "(" + text.ALONE + ")", "chr(57344) || '\\1' || chr(57344)"),
    "tag_split_soft": ("substr(text, 1, 9) || '<image>a cat</image> so ' || substr(text, 10, 15) || ' <gif>wave</gif>' || substr(text, 25)", "(" + text.BEGIN + ")", "chr(57344) || '\\1'"),
}


def _tag_query(name: str):
    made, pattern, mark = _TAGGED[name]

    @query(f"""WITH a AS (SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace({made}, '{pattern}', {mark}, 'g'), chr(57344)), lambda x: trim(x, {_BL})), lambda x: x <> '') AS p FROM conversations),
b AS (SELECT conv_id, turn, unnest(range(0, len(p))) AS piece_no, p FROM a) SELECT conv_id, turn, CAST(piece_no AS INTEGER) AS piece_no, p[piece_no + 1] AS piece FROM b""")
    def run(spark, sf_dir):
        rows = _read(spark, sf_dir, "conversations").withColumn("m", F.expr(made))
        return rows.select("conv_id", "turn", F.posexplode(text.split_tags(F.col("m"))).alias("piece_no", "piece"))

    for table in (QUERIES, SQL):
        table[name] = table.pop("run")


_tag_query("tag_split_hard")
_tag_query("tag_split_soft")


@query(f"SELECT conv_id, turn, trim(chr(160) || chr(12288) || text || chr(8195) || chr(10), {_BL}) AS m FROM conversations")
def strip_unicode(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip(F.concat(F.lit(" 　"), "text", F.lit(" \n"))).alias("m"))


# --- the flagship: merge and clean in one ----------------------------------------------------------------------

_CLEAN = f"""made AS (SELECT conv_id, turn, role, '<image>map</image> ' || role || ': ' || substr(text, 1, 30) || ' <delay hours="2"/> ' || substr(text, 31) AS m, conv_id // 2 AS chat FROM conversations),
sized AS (SELECT conv_id, chat, count(*) AS n FROM made GROUP BY conv_id, chat),
kept AS (SELECT min(conv_id) AS conv_id FROM sized WHERE n >= 2 GROUP BY chat),
scrubbed AS (SELECT made.conv_id, chat, turn, trim({_scrub_sql('m', ["'user'", "'assistant'"], [])}, {_BL}) AS m FROM made JOIN kept USING (conv_id)),
led AS (SELECT conv_id, chat, turn, trim(CASE WHEN starts_with(m, 'user') THEN substr(m, 5) ELSE m END, {_BL}) AS m FROM scrubbed),
done AS (SELECT conv_id, chat, turn, trim(CASE WHEN starts_with(m, 'assistant') THEN substr(m, 10) ELSE m END, {_BL}) AS m FROM led),
cut AS (SELECT conv_id, chat, turn, regexp_replace(regexp_replace(m, '({text.ALONE})', chr(57344) || '\\1' || chr(57344), 'g'), '({text.BEGIN})', chr(57344) || '\\1', 'g') AS m FROM done),
pieces AS (SELECT chat, conv_id, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, list_filter(list_transform(string_split(m, chr(57344)), lambda x: trim(x, {_BL})), lambda x: x <> '') AS p FROM cut),
numbered AS (SELECT chat, turn, p, unnest(range(0, len(p))) AS k FROM pieces)"""


@query(f"WITH {_CLEAN} SELECT 'c' || CAST(chat AS VARCHAR) AS chat_id, CAST(turn AS INTEGER) AS turn, CAST(k AS INTEGER) AS message_no, p[k + 1] AS message FROM numbered")
def merge_clean(spark, sf_dir):
    m = F.concat(F.lit("<image>map</image> "), "role", F.lit(": "), F.substring("text", 1, 30), F.lit(' <delay hours="2"/> '), F.expr("substr(text, 31)"))
    turns = _read(spark, sf_dir, "conversations").withColumn("part", F.struct(F.col("role").alias("sender"), F.array(m).alias("messages")))
    chats = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "part"))), lambda x: x["part"]).alias("chat_parts"))
    person = lambda name: F.struct(F.lit(name).alias("name"), F.lit(None).cast("string").alias("username"))
    chats = chats.withColumn("chat_id", F.concat(F.lit("c"), F.expr("conv_id div 2").cast("string"))).withColumn("experience", F.struct(person("user").alias("persona1"), person("assistant").alias("persona2")))
    kept = merge.keep_first(chats, "chat_id", ["conv_id"], F.size("chat_parts") >= 2).filter("status = 'written'")
    cleaned = kept.withColumn("chat_parts", merge.clean_parts(F.col("chat_parts"), F.col("experience")))
    return merge.messages_of(cleaned).select("chat_id", "turn", "message_no", "message")


@query(f"""WITH {_RECORDS} SELECT count(*) AS lines, CAST(sum(CAST(status = 'written' AS INTEGER)) AS BIGINT) AS written, CAST(sum(CAST(status = 'duplicate' AS INTEGER)) AS BIGINT) AS duplicate,
  CAST(sum(CAST(status = 'empty' AS INTEGER)) AS BIGINT) AS empty, CAST(sum(CAST(status = 'malformed' AS INTEGER)) AS BIGINT) AS malformed FROM marked""")
def merge_report(spark, sf_dir):
    """Chats written as JSON lines by id, read back as text and classified line by line."""
    n = F.col("n").cast("int")
    part = F.struct(F.lit("a").alias("sender"), F.array(F.lit("hi")).alias("messages"))
    rows = _records(spark, sf_dir).select(F.lit("f").alias("file"), F.col("pos").alias("line"), F.to_json(F.struct("chat_id", F.when(n > 0, F.array_repeat(part, n)).otherwise(F.array().cast("array<struct<sender:string,messages:array<string>>>")).alias("chat_parts")), prompts.JSON).alias("value"))
    _, marked = merge.merge_chats(rows)
    return merge.report(marked).select("lines", "written", "duplicate", "empty", "malformed")


# --- rollouts --------------------------------------------------------------------------------------------------

_WORDS = f"len(list_filter(string_split_regex(text, '[' || {_BL} || ']+'), lambda x: x <> ''))"


@query(f"SELECT conv_id, CAST(sum(CAST(floor({_WORDS} * 0.75) AS INTEGER)) AS BIGINT) AS tokens FROM conversations GROUP BY conv_id")
def token_estimate(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(text.token_estimate(F.array("text"))).alias("tokens"))


@query(f"""WITH a AS (SELECT conv_id, turn, CAST(floor({_WORDS} * 0.75) AS INTEGER) AS t FROM conversations),
b AS (SELECT conv_id, turn, sum(t) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS c FROM a),
d AS (SELECT conv_id, turn, c, coalesce(sum(CAST(c >= 80 AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops FROM b)
SELECT conv_id, count(*) AS turns, CAST(max(c) AS BIGINT) AS tokens FROM d WHERE stops = 0 GROUP BY conv_id""")
def rollout_stop(spark, sf_dir):
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.array("text").alias("messages"))
    return rollout.stop_turns(turns, "conv_id", "turn", "messages", 80).groupBy("conv_id").agg(F.count("*").alias("turns"), F.max("cum_tokens").alias("tokens"))


@query("""WITH a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, text || CASE WHEN turn % 3 = 1 THEN '<end/>' ELSE '' END AS m FROM conversations)
SELECT conv_id, turn, CASE WHEN n <= 4 THEN replace(m, '<end/>', '') ELSE m END AS m FROM a""")
def premature_end(spark, sf_dir):
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    m = F.concat("text", F.when(F.col("turn") % 3 == 1, F.lit(rollout.END)).otherwise(F.lit("")))
    rows = _read(spark, sf_dir, "conversations").withColumn("n", n).withColumn("m", m)
    return rows.select("conv_id", "turn", text.drop_premature_end(F.col("m"), F.col("n")).alias("m"))


@query("SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def transcript(spark, sf_dir):
    part = F.struct(F.col("role").alias("sender"), F.array("text").alias("messages"))
    chats = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", part.alias("p")))), lambda x: x["p"]).alias("parts"))
    rows = chats.withColumn("parts", F.transform("parts", lambda p: F.struct(F.when(p["sender"] == "user", F.lit("1")).otherwise(F.lit("2")).alias("sender"), F.transform(p["messages"], lambda m: F.when(p["sender"] == "system", F.concat(F.lit("system: "), m)).otherwise(m)).alias("messages"), (p["sender"] == "system").alias("sys"))))
    experience = F.struct(F.struct(F.lit("1").alias("id"), F.lit("user").alias("name")).alias("persona1"), F.struct(F.lit("2").alias("id"), F.lit("assistant").alias("name")).alias("persona2"))
    parts = F.transform("parts", lambda p: F.struct(F.when(p["sys"], F.lit("0")).otherwise(p["sender"]).alias("sender"), p["messages"].alias("messages")))
    return rows.select("conv_id", F.md5(prompts.transcript(parts, experience)).alias("digest"))


@query("""WITH a AS (SELECT conv_id, role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS same FROM conversations)
SELECT conv_id, CAST(sum(CAST(coalesce(same, false) AS INTEGER)) AS BIGINT) AS violations FROM a GROUP BY conv_id""")
def alternation_check(spark, sf_dir):
    return rollout.violations(_read(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


# --- draws -----------------------------------------------------------------------------------------------------

@query("""WITH p AS (SELECT s_suppkey AS pos, 18 + s_suppkey % 60 AS age FROM supplier)
SELECT abs(a.age - b.age) AS gap, count(*) AS pairs, round(sum(pow(1.0 / (abs(a.age - b.age) + 1), 2)), 6) AS mass FROM p a JOIN p b ON a.pos < b.pos GROUP BY gap""")
def pair_weights(spark, sf_dir):
    people = _read(spark, sf_dir, "supplier").select((18 + F.col("s_suppkey") % 60).alias("age"))
    classes = sampling.pair_classes(people, "age")
    return classes.groupBy(F.abs(F.col("age2") - F.col("age1")).alias("gap")).agg(F.sum("pairs").alias("pairs"), F.round(F.sum("mass"), 6).alias("mass"))


@query("""WITH p AS (SELECT n_nationkey AS pos, 20 + n_nationkey % 9 AS age FROM nation)
SELECT a.pos AS p1, b.pos AS p2, pow(1.0 / (abs(a.age - b.age) + 1), 2) AS weight FROM p a JOIN p b ON a.pos < b.pos""")
def pair_list(spark, sf_dir):
    people = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), (20 + F.col("n_nationkey") % 9).alias("age"))
    return sampling.weighted_pairs(people, "pos", "age").select(F.col("p1.pos").alias("p1"), F.col("p2.pos").alias("p2"), "weight")


_CUM = "SELECT *, sum(w) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) - w AS lo, sum(w) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS hi, sum(w) OVER () AS total FROM"


@query(f"""WITH v AS ({_CUM} {_values([(i, *m) for i, m in enumerate(MOODS)], 'pos, value, w')}), d AS (SELECT {_U.format(id='event_id')} AS u FROM events)
SELECT value, count(*) AS n FROM d JOIN v ON d.u * v.total >= v.lo AND d.u * v.total < v.hi GROUP BY value""")
def weighted_pick(spark, sf_dir):
    draws = _read(spark, sf_dir, "events").select(F.expr(_U.format(id="event_id")).alias("u"))
    vocabulary = _inline(spark, [(i, *m) for i, m in enumerate(MOODS)], "pos, value, w")
    return sampling.weighted_pick(draws, vocabulary, "u", "w", ["pos"]).groupBy("value").agg(F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT n_nationkey AS pos FROM nation), pairs AS (SELECT a.pos AS p1, b.pos AS p2, 1 + (a.pos * 3 + b.pos) % 5 AS w, a.pos * 100 + b.pos AS k FROM p a JOIN p b ON a.pos < b.pos),
v AS (SELECT *, sum(w) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) - w AS lo, sum(w) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS hi, sum(w) OVER () AS total FROM pairs), d AS (SELECT {_U.format(id='o_orderkey')} AS u FROM orders)
SELECT p1, p2, count(*) AS n FROM d JOIN v ON d.u * v.total >= v.lo AND d.u * v.total < v.hi GROUP BY p1, p2""")
def pair_pick(spark, sf_dir):
    people = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.lit(1).alias("age"))
    pairs = sampling.weighted_pairs(people, "pos", "age").select(F.col("p1.pos").alias("p1"), F.col("p2.pos").alias("p2"))
    pairs = pairs.withColumn("w", 1 + (F.col("p1") * 3 + F.col("p2")) % 5)
    draws = _read(spark, sf_dir, "orders").select(F.expr(_U.format(id="o_orderkey")).alias("u"))
    return sampling.weighted_pick(draws, pairs, "u", "w", ["p1", "p2"]).groupBy("p1", "p2").agg(F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT n_nationkey AS pos, 20 + n_nationkey % 4 AS age FROM nation), c AS (SELECT a.pos AS p1, b.pos AS p2, least(a.age, b.age) AS a1, greatest(a.age, b.age) AS a2 FROM p a JOIN p b ON a.pos < b.pos),
d AS (SELECT count(*) AS n FROM orders) SELECT a1 AS age1, a2 AS age2, count(*) AS pairs FROM c GROUP BY a1, a2""")
def pair_draw_classes(spark, sf_dir):
    people = _read(spark, sf_dir, "nation").select((20 + F.col("n_nationkey") % 4).alias("age"))
    return sampling.pair_classes(people, "age").select("age1", "age2", "pairs")


def _pick_sql(name: str) -> str:
    values = PICKS[name]
    return "CASE " + " ".join(f"WHEN (event_id * {len(name)}) % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@query(f"""WITH v AS ({_CUM} {_values([(i, *m) for i, m in enumerate(TIES)], 'pos, tie, w')}), d AS (SELECT event_id, {_U.format(id='event_id')} AS u FROM events),
j AS (SELECT event_id, tie FROM d JOIN v ON d.u * v.total >= v.lo AND d.u * v.total < v.hi)
SELECT CASE {' '.join(f"WHEN contains(tie, '{{{n}}}') THEN replace(tie, '{{{n}}}', {_pick_sql(n)})" for n in PICKS)} ELSE tie END AS relationship, count(*) AS n FROM j GROUP BY relationship""")
def relationship_resolve(spark, sf_dir):
    draws = _read(spark, sf_dir, "events").select("event_id", F.expr(_U.format(id="event_id")).alias("u"))
    ties = _inline(spark, [(i, *m) for i, m in enumerate(TIES)], "pos, tie, w")
    picked = sampling.weighted_pick(draws, ties, "u", "w", ["pos"])
    resolved = sampling.resolve_template(F.col("tie"), {n: F.expr(_pick_sql(n)) for n in PICKS})
    return picked.groupBy(resolved.alias("relationship")).agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT n_nationkey AS item, row_number() OVER (ORDER BY n_nationkey) - 1 AS place, count(*) OVER () AS size FROM nation),
a AS (SELECT event_id, (event_id * 31) % 25 AS p1, ((event_id * 31) % 25 + 1 + (event_id * 17) % 24) % 25 AS p2 FROM events), b AS (SELECT event_id, 1 AS n, p1 AS q FROM a UNION ALL SELECT event_id, 2, p2 FROM a)
SELECT event_id, n, item FROM b JOIN p ON b.q = p.place""")
def few_shot_k2(spark, sf_dir):
    pool = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("item"))
    return sampling.few_shot(_read(spark, sf_dir, "events"), pool, "event_id", ["item"], F.col("event_id") * 31, F.col("event_id") * 17).select("event_id", "n", "item")


@query("SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE conv_id % 3 = 0)")
def resume_antijoin(spark, sf_dir):
    ids = _read(spark, sf_dir, "conversations").select("conv_id").distinct()
    return sampling.unprocessed(ids, ids.filter("conv_id % 3 = 0"), "conv_id")


@query("SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 3 <> 0) ORDER BY conv_id LIMIT 40")
def prefix_limit(spark, sf_dir):
    return sampling.prefix(resume_antijoin(spark, sf_dir), 40, "conv_id")


# --- languages -------------------------------------------------------------------------------------------------

def _lang_chats(spark, sf_dir):
    """A wrapped chat for each document: its text is the scene, its lines are messages, some of them tags."""
    docs = _read(spark, sf_dir, "documents")
    line = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 4 == 3, F.concat(F.lit("<image>"), x)).otherwise(x))
    person = lambda k: F.struct(F.concat(F.lit(k), "doc_id").alias("id"), F.array("lang", "source").alias("traits"), F.col("source").alias("background"), F.col("lang").alias("chatting_style"))
    scene = F.struct(person("a").alias("persona1"), person("b").alias("persona2"), F.col("lang").alias("relationship"), F.col("source").alias("situation"), F.substring("text", 1, 20).alias("topic"))
    return docs.select(F.col("doc_id").alias("chat_id"), scene.alias("experience"), F.array(F.struct(F.concat(F.lit("a"), "doc_id").alias("sender"), line.alias("messages"))).alias("chat_parts"))


_LINES = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
m AS (SELECT doc_id, i, CASE WHEN i % 4 = 3 THEN '<image>' || x ELSE x END AS m FROM l)"""


@query(f"WITH {_LINES} SELECT CASE WHEN starts_with(m, '<') THEN 'tag' ELSE 'en' END AS kind, count(*) AS n, CAST(sum(length(m)) AS BIGINT) AS chars FROM m GROUP BY kind")
def lang_wrap(spark, sf_dir):
    rows = multilang.wrap(_lang_chats(spark, sf_dir)).select(F.explode("chat_parts").alias("p")).select(F.explode("p.messages").alias("m")).select(F.explode("m").alias("kind", "m"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("m")).alias("chars"))


_GATHERED = f"""{_LINES}, g AS (
SELECT doc_id, p AS kind, 'traits' AS field, 0 AS idx1, -1 AS idx2, lang AS t FROM documents, (VALUES ('persona1'), ('persona2')) AS q(p) UNION ALL
SELECT doc_id, p, 'traits', 1, -1, source FROM documents, (VALUES ('persona1'), ('persona2')) AS q(p) UNION ALL
SELECT doc_id, p, 'background', -1, -1, source FROM documents, (VALUES ('persona1'), ('persona2')) AS q(p) UNION ALL
SELECT doc_id, p, 'chatting_style', -1, -1, lang FROM documents, (VALUES ('persona1'), ('persona2')) AS q(p) UNION ALL
SELECT doc_id, 'scene', 'relationship', -1, -1, lang FROM documents UNION ALL SELECT doc_id, 'scene', 'situation', -1, -1, source FROM documents UNION ALL
SELECT doc_id, 'scene', 'topic', -1, -1, substr(text, 1, 20) FROM documents UNION ALL
SELECT doc_id, 'message', 'messages', 0, i, m FROM m WHERE NOT starts_with(m, '<'))"""


@query(f"WITH {_GATHERED} SELECT doc_id AS chat_id, kind, field, CAST(idx1 AS INTEGER) AS idx1, CAST(idx2 AS INTEGER) AS idx2, md5(t) AS digest FROM g")
def lang_gather(spark, sf_dir):
    items = multilang.gather(multilang.wrap(_lang_chats(spark, sf_dir)))
    return items.select("chat_id", "kind", "field", "idx1", "idx2", F.md5("text").alias("digest"))


@query(f"""WITH {_GATHERED}, t AS (SELECT doc_id, kind, field, idx1, idx2, CASE WHEN trim(t, {_BL}) <> '' AND NOT starts_with(trim(t, {_BL}), '<') THEN translate(t, '{ascii_lowercase}', '{ascii_uppercase}') ELSE t END AS u FROM g)
SELECT doc_id AS chat_id, max(CASE WHEN field = 'topic' THEN u END) AS topic, max(CASE WHEN kind = 'persona2' AND field = 'traits' AND idx1 = 1 THEN u END) AS trait, max(CASE WHEN kind = 'persona1' AND field = 'background' THEN u END) AS background,
  coalesce(md5(string_agg(CASE WHEN kind = 'message' THEN u END, chr(10) ORDER BY idx2)), md5('')) AS digest FROM t GROUP BY doc_id""")
def lang_merge(spark, sf_dir):
    """Gathered, translated by a stand-in (A-Z for a-z) and put back, texts compared."""
    wrapped = multilang.wrap(_lang_chats(spark, sf_dir))
    items = multilang.gather(wrapped)
    done = items.withColumn("language", F.lit("de")).withColumn("translated", F.when(multilang.translatable(F.col("text")), F.translate("text", ascii_lowercase, ascii_uppercase)).otherwise(F.col("text")))
    out = multilang.merge_translations(wrapped, done)
    x = F.col("experience")
    de = F.filter(F.transform(F.flatten(F.transform("chat_parts", lambda p: p["messages"])), lambda m: m["de"]), lambda m: m.isNotNull())
    return out.select("chat_id", x["topic"]["de"].alias("topic"), x["persona2"]["traits"]["de"][1].alias("trait"), x["persona1"]["background"]["de"].alias("background"), F.md5(F.array_join(de, "\n")).alias("digest"))


@query(f"""WITH a AS (SELECT text AS t FROM documents UNION ALL SELECT v FROM documents, (VALUES ('  '), (' <gif>x</gif>'), ('<gif>x</gif> and more'), (chr(160))) AS q(v))
SELECT starts_with(t, '<') AS is_tag, trim(t, {_BL}) <> '' AND NOT starts_with(trim(t, {_BL}), '<') AS is_text, count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS chars FROM a GROUP BY is_tag, is_text""")
def translate_filter(spark, sf_dir):
    """Every text, and for each the special cases as further rows."""
    cases = [F.lit(x) for x in ("  ", " <gif>x</gif>", "<gif>x</gif> and more", "\u00a0")]
    rows = _read(spark, sf_dir, "documents").select(F.explode(F.array(F.col("text"), *cases)).alias("t"))
    return rows.groupBy(F.startswith("t", F.lit("<")).alias("is_tag"), multilang.translatable(F.col("t")).alias("is_text")).agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars"))


@query("""SELECT lang AS language FROM (SELECT lang FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents) UNION SELECT 'it') AS t WHERE lang IN ('de', 'es', 'it', 'fr') AND lang <> 'en'""")
def lang_conflict(spark, sf_dir):
    """The library's check on a multilingual table: the first record already has its own language and Italian."""
    first = _lang_chats(spark, sf_dir).orderBy("chat_id").limit(1)
    x = F.col("experience")
    chats = multilang.wrap(first).withColumn("experience", x.withField("topic", F.map_concat(x["topic"], F.create_map(F.lit("it"), F.lit("x")), F.map_filter(F.create_map(x["persona1"]["chatting_style"][multilang.SOURCE], F.lit("y")), lambda k, _: ~k.isin("en", "it")))))
    found = multilang.conflicts(chats, ["de", "es", "it", "fr", "en"])
    return spark.createDataFrame([(x,) for x in found], "language string")


@query("""SELECT event_type, count(*) AS n, CAST(count(*) AS BIGINT) AS keys, count(props) AS props FROM events GROUP BY event_type""")
def json_nulls(spark, sf_dir):
    """Records written as JSON with nulls kept: the key of a null field is in the text."""
    rows = _read(spark, sf_dir, "events").select("event_type", "props", F.lit(None).cast("string").alias("missing"))
    said = rows.select("event_type", F.to_json(F.struct("*"), prompts.JSON).alias("j"))
    again = said.select("event_type", F.array_contains(F.json_object_keys("j"), "missing").alias("key"), F.get_json_object("j", "$.props").alias("props"))
    return again.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("key").alias("keys"), F.count("props").alias("props"))


# --- draws at scale, prompts, identifiers -----------------------------------------------------------------------

@query(f"""WITH p AS (SELECT s_suppkey AS pos, 18 + s_suppkey % 9 AS age, row_number() OVER (PARTITION BY 18 + s_suppkey % 9 ORDER BY s_suppkey) - 1 AS k FROM supplier),
a AS (SELECT age, count(*) AS n FROM p GROUP BY age),
c AS (SELECT x.age AS a1, y.age AS a2, y.n AS n2, CASE WHEN x.age = y.age THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END AS pairs FROM a x JOIN a y ON x.age <= y.age),
m AS (SELECT *, pairs * pow(1.0 / (abs(a1 - a2) + 1), 2) AS w FROM c WHERE pairs > 0),
v AS (SELECT *, sum(w) OVER (ORDER BY a1, a2 ROWS UNBOUNDED PRECEDING) AS hi, sum(w) OVER () AS total FROM m),
d AS (SELECT event_id, {_U.format(id='event_id')} AS u1, ((event_id * 104729) % 9973) / CAST(9973 AS DOUBLE) AS u2 FROM events),
j AS (SELECT event_id, a1, a2, n2, CAST(least(floor(u2 * pairs), pairs - 1) AS BIGINT) AS k FROM d JOIN v ON u1 * total >= hi - w AND u1 * total < hi),
t AS (SELECT *, CAST(floor((1 + sqrt(8.0 * k + 1)) / 2) AS BIGINT) AS jj FROM j),
i AS (SELECT event_id, a1, a2, CASE WHEN a1 = a2 THEN k - jj * (jj - 1) // 2 ELSE k // n2 END AS ka, CASE WHEN a1 = a2 THEN jj ELSE k % n2 END AS kb FROM t)
SELECT event_id, least(x.pos, y.pos) AS p1, greatest(x.pos, y.pos) AS p2 FROM i JOIN p x ON x.age = a1 AND x.k = ka JOIN p y ON y.age = a2 AND y.k = kb""")
def pair_draws(spark, sf_dir):
    """Pairs by likeness of ages without a list of all pairs."""
    people = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), (18 + F.col("s_suppkey") % 9).alias("age"))
    draws = _read(spark, sf_dir, "events").select("event_id", F.expr(_U.format(id="event_id")).alias("u1"), F.expr("((event_id * 104729) % 9973) / CAST(9973 AS DOUBLE)").alias("u2"))
    return sampling.draw_pairs(draws, people, "pos", "age", "u1", "u2").select("event_id", "p1", "p2")


_PERSON = "'{{\"name\":\"' || {n} || '\",\"age\":' || CAST({a} AS VARCHAR) || ',\"traits\":[\"calm\"],\"background\":null,\"chatting_style\":\"short\"}}'"


def _persona(name, age):
    return F.struct(name.alias("name"), F.lit("u").alias("username"), age.cast("int").alias("age"), F.array(F.lit("calm")).alias("traits"), F.lit(None).cast("string").alias("background"), F.lit("short").alias("chatting_style"), F.lit("m").alias("model"), F.concat(F.lit("id"), name).alias("id"))


@query(f"""WITH p AS (SELECT s_suppkey AS k, {_PERSON.format(n="CAST(s_suppkey AS VARCHAR)", a="s_suppkey % 60")} AS p1, {_PERSON.format(n="'x'", a="30")} AS p2 FROM supplier)
SELECT k, 'First: ' || p1 || chr(10) || 'Second: ' || p2 || chr(10) || 'Tie: friends' || chr(10) || 'Spark: a photo' AS body, 'Reference 1' || chr(10) || 'First: ' || p1 || chr(10) || 'Second: ' || p2 || chr(10) || 'Tie: t' || chr(10) || 'Scene: s' || chr(10) || 'Subject: o' AS example,
  'id' || CAST(k AS VARCHAR) || '_idx_17' AS chat_id, 'tiny' AS model FROM p""")
def scenario_prompts(spark, sf_dir):
    """Lean personas, the prompt for a scenario, the block of examples, the chat's id and the model's short name."""
    k = F.col("s_suppkey")
    p1, p2 = _persona(k.cast("string"), k % 60), _persona(F.lit("x"), F.lit(30))
    none = prompts.example_block(F.array().cast("array<struct<persona1:struct<name:string,username:string,model:string,id:string>,persona2:struct<name:string,username:string,model:string,id:string>,relationship:string,situation:string,topic:string>>"))
    asked = prompts.scenario_prompt(p1, p2, F.lit("friends"), F.lit("a photo"), none)
    one = F.array(F.struct(p1.alias("persona1"), p2.alias("persona2"), F.lit("t").alias("relationship"), F.lit("s").alias("situation"), F.lit("o").alias("topic")))
    return _read(spark, sf_dir, "supplier").select(k.alias("k"), asked[1]["content"].alias("body"), prompts.example_block(one).alias("example"), prompts.chat_id(p1, p2, F.lit(17)).alias("chat_id"), prompts.short_model(F.lit("org/tiny")).alias("model"))


@query(f"""WITH a AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN ['  ', text, chr(160)] WHEN 2 THEN [] ELSE [text || '<end/>', 'x'] END AS m, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT conv_id, turn, array_to_string(list_transform(list_filter(m, lambda x: trim(x, {_BL}) <> ''), lambda x: CASE WHEN n <= 4 THEN replace(x, '<end/>', '') ELSE x END), '|') AS said, m IS NULL AS failed FROM a""")
def parse_answers(spark, sf_dir):
    """A model's JSON answers as messages: blank ones dropped, early end tags taken out, no JSON is a failure."""
    m = F.expr("CASE turn % 4 WHEN 1 THEN array('  ', text, '\u00a0') WHEN 2 THEN array() ELSE array(concat(text, '<end/>'), 'x') END")
    content = F.when(F.col("turn") % 4 == 0, F.lit("no json")).otherwise(F.to_json(F.struct(m.alias("messages"))))
    rows = _read(spark, sf_dir, "conversations").withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")))
    said = rollout.parse_turn(content, F.col("n"))
    return rows.select("conv_id", "turn", F.array_join(said, "|").alias("said"), said.isNull().alias("failed"))


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
