r"""Chat formatting with a prefix tree.

A turn becomes the segment `### role: text</turn>\n`; in texts a backslash, `###` and `</turn>`
get a backslash in front, in roles a backslash, `:`, `#` and `<`. That is reversible and no
text can look like a control string. Conversations that share initial turns share nodes: a
node is the chain hash of its segments. The stream holds every node once, depth first; each
node carries its offset in the stream, the position id of its first character (as if its
conversation stood alone), the intervals of its ancestors (all a token may attend to besides
earlier tokens of its own node) and the interval under the loss mask.

Depth-first order is the order of paths, so offsets are a prefix sum over range partitions: a
first turn that a third of all conversations share is one node, and its subtree is spread over
as many partitions as it needs. A conversation is one row while its prefixes are hashed.

Defined results: null text or role is empty; rows of one conversation are ordered by turn, role
and text, and repeated rows are repeated turns; a null conversation id is a conversation
of its own; equal conversations share all nodes; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.llm.tables import stored

END = "</turn>\n"
TRAINED = "assistant"
TEXT_CONTROLS = r"(\\|###|</turn>)"
ROLE_CONTROLS = r"([\\:#<])"
PARTS = r"(?s)^### ((?:[^\\:]|\\.)*+): (.*)</turn>\n$"


def segment(role: Column, text: Column) -> Column:
    head = F.concat(F.lit("### "), F.regexp_replace(role, ROLE_CONTROLS, r"\\$1"), F.lit(": "))
    return F.concat(head, F.regexp_replace(text, TEXT_CONTROLS, r"\\$1"), F.lit(END))


def role_of(part: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(part, PARTS, 1), r"(?s)\\(.)", "$1")


def text_of(part: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(part, PARTS, 2), r"\\" + TEXT_CONTROLS, "$1")


def _chains(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key, ancestors' keys, path, position, segment, role."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select("conv_id", F.struct("turn", "role", "text", segment(F.col("role"), F.col("text")).alias("segment")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    begin = F.array(F.struct(F.lit("").alias("key"), F.lit(0).cast("bigint").alias("end")))

    def extend(done: Column, t: Column) -> Column:
        last = F.element_at(done, -1)
        key = F.md5(F.concat(last.key, t.segment).cast("binary"))
        return F.concat(done, F.array(F.struct(key.alias("key"), (last.end + F.char_length(t.segment)).alias("end"))))

    chained = convs.withColumn("chain", F.aggregate("ts", begin, extend))
    nodes = chained.select("conv_id", "chain", F.posexplode("ts").alias("depth", "t"))
    return nodes.select(
        "conv_id", "depth", F.col("chain")[F.col("depth") + 1].key.alias("key"),
        F.array_join(F.transform(F.slice("chain", 2, F.col("depth") + 1), lambda c: F.substring(c.key, 1, 16)), "").alias("path"),
        F.col("chain")[F.col("depth")].end.alias("position"), F.col("t.role").alias("role"), F.col("t.segment").alias("segment"),
    )


def prefix_tree(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stream of nodes and, for each conversation, the offset of its last node.

    Stream: start, end, position, depth, ancestors (array of start and end), text (the
    segment), loss_start, loss_end (null where nothing is trained)."""
    spark = turns.sparkSession
    chains = stored(_chains(turns), "chains")
    value = ["path", "depth", "position", "role", "segment"]
    nodes = chains.groupBy("key").agg(*[F.first(c).alias(c) for c in value])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, "path").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged.withColumn("n", F.char_length("segment").cast("bigint")), "nodes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = ranged.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    running = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("n").over(running)).join(bases, "part")
    placed = placed.withColumn("start", F.col("base") + F.col("upto") - F.col("n"))
    placed = stored(placed.select("key", "start", (F.col("start") + F.col("n")).alias("end"), *value), "placed")

    spans = placed.select("key", F.struct("depth", "start", "end").alias("span"))
    known = chains.select("conv_id", "key").join(spans, "key")
    lines = stored(known.groupBy("conv_id").agg(F.sort_array(F.collect_list("span")).alias("spans")), "lines")
    members = lines.select("conv_id", F.element_at("spans", -1).start.alias("start"))
    above = lines.select("spans", F.posexplode("spans").alias("k", "span")).select(
        F.col("span.start").alias("start"),
        F.transform(F.slice("spans", 1, F.col("k")), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"))).alias("ancestors"),
    )
    above = above.groupBy("start").agg(F.first("ancestors").alias("ancestors"))
    inner = F.col("end") - len(END)
    head = F.char_length(F.regexp_extract("segment", r"(?s)^### (?:[^\\:]|\\.)*+: ", 0))
    trained = F.col("role") == TRAINED
    stream = placed.join(above, "start").select(
        "start", "end", "position", "depth", "ancestors", F.col("segment").alias("text"),
        F.when(trained, F.col("start") + head).alias("loss_start"), F.when(trained, inner).alias("loss_end"),
    )
    return stored(stream, "stream"), members


def read_back(stream: DataFrame, members: DataFrame) -> DataFrame:
    """Turns of each conversation from the stream alone: conv_id, depth, role, text, masked text."""
    last = members.join(stream.select("start", "ancestors"), "start")
    own = F.transform(F.col("ancestors"), lambda a: a.start)
    places = last.select("conv_id", F.explode(F.concat(own, F.array("start"))).alias("start"))
    rows = places.join(stream.drop("ancestors"), "start")
    masked = F.substring(F.col("text"), F.col("loss_start") - F.col("start") + 1, F.col("loss_end") - F.col("loss_start"))
    return rows.select(
        "conv_id", "depth", role_of(F.col("text")).alias("role"), text_of(F.col("text")).alias("text"),
        F.regexp_replace(masked, r"\\" + TEXT_CONTROLS, "$1").alias("masked"), F.char_length("text").cast("bigint").alias("chars"),
    )


def chat_report(turns: DataFrame) -> DataFrame:
    rows = read_back(*prefix_tree(turns))
    turn = F.struct("depth", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), F.coalesce("masked", F.lit("")).alias("masked"))
    convs = rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("ts"), F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.col("ts.masked"), "")
    return convs.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("ts.turn"), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


# A conversation whose texts hold the template's own control strings.
HARD_ID, HARD_TEXT = -7, r"\### Assistant: </turn> ok"


def with_hard_conversation(turns: DataFrame) -> DataFrame:
    hard = turns.sparkSession.createDataFrame(
        [(HARD_ID, 0, "user", HARD_TEXT), (HARD_ID, 1, "assistant", HARD_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(hard)


OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(14 + length(replace(replace(replace(replace(role, '\', '\\'), ':', '\:'), '#', '\#'), '<', '\<'))
              + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
