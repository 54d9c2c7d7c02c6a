"""Quotation linking with DataFrame functions: messages to the messages they quote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import stored

# How a line that introduces a quotation begins and ends, by language.
ATTRIBUTION = (
    r"(?m)^(?:On|Am|Le|El)[ \t][^\n]{0,200}(?:wrote|schrieb[^\n]{0,80}|a écrit|escribió)[ \t]*:"
    r"[ \t]*\r?\n(?=[ \t]*>)"
)
QUOTED = r"^[ \t]*>"
MARKS = r"^[ \t]*(?:>[ \t]*)+"
_FIRST = -(1 << 62)


def _messages(messages: DataFrame, thread: str, order: str, role: str, text: str) -> DataFrame:
    """Distinct messages under a key; a message without a thread is a thread by itself."""
    body = F.coalesce(F.col(text), F.lit(""))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in (thread, order, role)]
    key = F.sha2(F.concat_ws("\u0001", *parts, body), 256)
    rows = messages.select(
        F.col(thread).alias("thread"),
        F.col(order).cast("long").alias("turn"),
        F.col(role).alias("role"),
        body.alias("text"),
        key.alias("mid"),
    )
    alone = F.coalesce(F.col("thread").cast("string"), F.concat(F.lit("\u0000"), F.col("mid")))
    return rows.withColumn("tkey", alone).withColumn("ord", F.coalesce("turn", F.lit(_FIRST)))


def _lines(rows: DataFrame) -> DataFrame:
    """A row for each line that is not blank: its quote level, its text without the marks, and
    the passage it is in. A passage is a run of lines of one level without a blank line."""
    bare = F.regexp_replace("text", ATTRIBUTION, "")
    line = F.posexplode(F.split(bare, r"\r\n|\r|\n")).alias("at", "line")
    lines = rows.select("tkey", "ord", "mid", line)
    marks = F.regexp_extract("line", f"({MARKS})", 1)
    lines = lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
    lines = lines.withColumn("body", F.trim(F.regexp_replace("line", MARKS, "")))
    # Windows stay within one message.
    before = "lag({}) over (partition by mid order by at)"
    breaks = F.expr(
        f"case when body = '' or level <> {before.format('level')} "
        f"or {before.format('body')} = '' then 1 else 0 end"
    )
    passage = F.expr("sum(breaks) over (partition by mid order by at rows unbounded preceding)")
    return lines.withColumn("breaks", breaks).withColumn("passage", passage).where("body <> ''")


def _units(lines: DataFrame) -> DataFrame:
    """Sentences of passages, normalised and hashed: a quotation that was wrapped anew, or that
    keeps only some sentences, still has whole sentences of its original."""
    passages = lines.groupBy("tkey", "ord", "mid", "passage", "level").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " "
        ).alias("words")
    )
    units = passages.select(
        "tkey", "ord", "mid", "level", F.explode(F.regexp_extract_all("words", F.lit("[^.!?]+"), 0)).alias("unit")
    )
    normal = F.trim(F.lower(F.regexp_replace("unit", r"[^\p{L}\p{N}]+", " ")))
    units = units.withColumn("unit", normal).where("unit <> ''")
    return units.select("tkey", "ord", "mid", "level", F.md5("unit").alias("unit"))


def _depths(parents: DataFrame) -> DataFrame:
    """(mid, depth, branch) from (mid, turn, up, top): ``up`` is the parent, ``top`` tells that
    the parent opens the thread. Pointers double in length in each round."""
    start = parents.select(
        "mid",
        F.when(F.col("top"), F.lit(None)).otherwise(F.col("up")).alias("up"),
        F.lit(1).cast("long").alias("depth"),
        F.col("turn").alias("branch"),
    )
    state = stored(start, "replies")
    while not state.where("up is not null").isEmpty():
        above = state.select(
            F.col("mid").alias("up"),
            F.col("up").alias("up2"),
            F.col("depth").alias("depth2"),
            F.col("branch").alias("branch2"),
        )
        moved = state.where("up is not null").join(above, "up")
        moved = moved.select(
            "mid",
            F.col("up2").alias("up"),
            (F.col("depth") + F.col("depth2")).alias("depth"),
            F.col("branch2").alias("branch"),
        )
        state = stored(state.where("up is null").unionAll(moved), "replies")
    return state.select("mid", "depth", "branch")


def link_quotes(
    messages: DataFrame,
    thread: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Messages without their quotations, in reply order, linked to what they quote.

    One row for each row of ``messages``, sorted by thread, branch, depth and order: thread,
    order, role, n_quoted (quoted sentences), n_linked (those with an original), max_level,
    parent (order of the message answered), branch (order of the reply to the opening message
    that it descends from), depth (0 for the opening message) and body (the text without
    quotations and the lines that introduce them).

    Quote levels are the runs of ``>`` before a line. Sentences of quoted passages, in lower
    case and without punctuation, are hashed and joined to the first message of the thread
    that has them as its own words; it must be earlier. The parent is the original of most
    sentences at the lowest level that has one (ties: the latest). A message that quotes
    nothing known answers the one that opened its thread. Originals are found by aggregates
    that combine before the shuffle, so a sentence that a thread repeats adds no pairs, and no
    window or list spans a thread.

    A null text counts as empty. A message with a null thread is a thread by itself; a null
    order comes first. Repeated rows each give a row and are one message. Messages of one order
    do not quote each other. An empty table gives no rows. Other columns are not read.
    """
    rows = _messages(messages, thread, order, role, text)
    marked = F.col("text").rlike(r"(?m)^[ \t]*>")
    unique = rows.select("tkey", "ord", "turn", "mid", "text").distinct()
    quoting = unique.where(marked)
    quoted = stored(_units(_lines(quoting)).where("level > 0"), "quoted")
    # Only threads that quote at all need the sentences of their messages.
    asked = quoted.select("tkey", "unit").distinct()
    candidates = unique.join(quoted.select("tkey").distinct(), "tkey", "left_semi")
    own = _units(_lines(candidates)).where("level = 0").join(asked, ["tkey", "unit"], "left_semi")
    first = own.groupBy("tkey", "unit").agg(F.min(F.struct("ord", "mid")).alias("first"))
    linked = quoted.join(first, ["tkey", "unit"], "left").withColumn(
        "source", F.when(F.col("first.ord") < F.col("ord"), F.col("first"))
    )
    linked = stored(linked.select("mid", "level", "source"), "linked")
    counts = linked.groupBy("mid").agg(
        F.count(F.lit(1)).alias("n_quoted"),
        F.count("source").alias("n_linked"),
        F.max("level").alias("max_level"),
    )
    votes = linked.where("source is not null").groupBy("mid", "level", "source").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("mid").agg(F.max(F.struct(-F.col("level"), "n", "source")).alias("best"))
    best = best.select("mid", F.col("best.source").alias("source"))

    openers = unique.groupBy("tkey").agg(F.min(F.struct("ord", "mid")).alias("opener"))
    placed = (
        unique.select("tkey", "ord", "turn", "mid")
        .join(openers, "tkey")
        .join(best, "mid", "left")
        .withColumn("parent", F.coalesce("source", "opener"))
    )
    placed = stored(
        placed.select(
            "mid", "turn", F.col("parent.ord").alias("parent_ord"), F.col("parent.mid").alias("up"),
            (F.col("parent.mid") == F.col("opener.mid")).alias("top"),
            (F.col("mid") == F.col("opener.mid")).alias("opens"),
        ),
        "parents",
    )
    depths = _depths(placed.where(~F.col("opens")))
    facts = (
        placed.join(depths, "mid", "left")
        .join(counts, "mid", "left")
        .select(
            F.col("mid").alias("of"),
            F.when(~F.col("opens") & (F.col("parent_ord") > _FIRST), F.col("parent_ord")).alias("parent"),
            F.when(F.col("opens"), F.col("turn")).otherwise(F.col("branch")).alias("branch"),
            F.when(F.col("opens"), 0).otherwise(F.col("depth")).cast("long").alias("depth"),
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quoted", "n_linked", "max_level")),
        )
    )
    lines = F.split(F.regexp_replace("text", ATTRIBUTION, ""), r"\r\n|\r|\n")
    body = F.array_join(F.filter(lines, lambda line: ~line.rlike(QUOTED)), "\n")
    body = F.regexp_replace(body, r"^[ \t\n]+|[ \t\n]+$", "")
    joined = rows.join(facts, F.col("mid") == F.col("of")).select(
        F.col("thread").alias(thread), F.col("turn").alias(order), F.col("role").alias(role),
        "n_quoted", "n_linked", "max_level", "parent", "branch", "depth", body.alias("body"),
    )
    return joined.orderBy(thread, "branch", "depth", order, role, "body")


LINK_SQL = r"""
WITH RECURSIVE rows_ AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text,
         sha256(concat_ws(chr(1), coalesce(CAST(conv_id AS VARCHAR), '?'),
                coalesce(CAST(turn AS VARCHAR), '?'), coalesce(role, '?'), coalesce(text, ''))) AS mid
  FROM conversations),
keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '?' || mid) AS tkey,
         coalesce(turn, -4611686018427387904) AS ord,
         regexp_replace(text, '(^|\n)(?:On|Am|Le|El)[ \t][^\n]{0,200}(?:wrote|schrieb[^\n]{0,80}|a écrit|escribió)[ \t]*:[ \t]*\r?\n([ \t]*>)', '\1\2', 'g') AS bare
  FROM rows_),
messages AS (SELECT DISTINCT tkey, ord, turn, mid, bare FROM keyed),
numbered AS (
  SELECT tkey, ord, mid, unnest(string_split_regex(bare, '\r\n|\r|\n')) AS line,
         generate_subscripts(string_split_regex(bare, '\r\n|\r|\n'), 1) AS pos
  FROM messages),
lines AS (
  SELECT tkey, ord, mid, pos,
         length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g')) AS level,
         trim(regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', ''), ' ') AS body
  FROM numbered),
broken AS (
  SELECT *, CASE WHEN body = '' OR level <> lag(level) OVER w OR lag(body) OVER w = '' THEN 1 ELSE 0 END AS breaks
  FROM lines WINDOW w AS (PARTITION BY mid ORDER BY pos)),
grouped AS (
  SELECT *, sum(breaks) OVER (PARTITION BY mid ORDER BY pos ROWS UNBOUNDED PRECEDING) AS passage FROM broken),
passages AS (
  SELECT tkey, ord, mid, level, passage, string_agg(body, ' ' ORDER BY pos) AS words
  FROM grouped WHERE body <> '' GROUP BY ALL),
pieces AS (
  SELECT tkey, ord, mid, level, unnest(regexp_extract_all(words, '[^.!?]+')) AS unit FROM passages),
units AS (
  SELECT tkey, ord, mid, level, trim(lower(regexp_replace(unit, '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS unit FROM pieces),
first_own AS (
  SELECT tkey, unit, min(struct_pack(ord := ord, mid := mid)) AS first
  FROM units WHERE level = 0 AND unit <> '' GROUP BY ALL),
linked AS (
  SELECT q.mid, q.level, CASE WHEN f.first.ord < q.ord THEN f.first END AS source
  FROM units q LEFT JOIN first_own f ON f.tkey = q.tkey AND f.unit = q.unit
  WHERE q.level > 0 AND q.unit <> ''),
counts AS (
  SELECT mid, count(*) AS n_quoted, count(source) AS n_linked, max(level) AS max_level FROM linked GROUP BY mid),
votes AS (
  SELECT mid, level, source, count(*) AS n FROM linked WHERE source IS NOT NULL GROUP BY ALL),
best AS (
  SELECT mid, max(struct_pack(low := -level, n := n, source := source)).source AS source FROM votes GROUP BY mid),
openers AS (SELECT tkey, min(struct_pack(ord := ord, mid := mid)) AS opener FROM messages GROUP BY tkey),
parents AS (
  SELECT m.mid, m.turn, coalesce(b.source, o.opener).mid AS up, coalesce(b.source, o.opener).ord AS parent_ord,
         o.opener.mid AS top, m.mid = o.opener.mid AS opens
  FROM messages m JOIN openers o USING (tkey) LEFT JOIN best b ON b.mid = m.mid),
tree AS (
  SELECT mid, CAST(0 AS BIGINT) AS depth, turn AS branch, opens FROM parents WHERE opens
  UNION ALL
  SELECT p.mid, t.depth + 1, CASE WHEN t.opens THEN p.turn ELSE t.branch END, FALSE
  FROM parents p JOIN tree t ON p.up = t.mid WHERE NOT p.opens)
SELECT k.conv_id, k.turn, k.role, CAST(coalesce(c.n_quoted, 0) AS BIGINT) AS n_quoted,
       CAST(coalesce(c.n_linked, 0) AS BIGINT) AS n_linked, CAST(coalesce(c.max_level, 0) AS BIGINT) AS max_level,
       CASE WHEN NOT p.opens AND p.parent_ord > -4611686018427387904 THEN p.parent_ord END AS parent,
       t.branch, t.depth,
       regexp_replace(array_to_string([x FOR x IN string_split_regex(k.bare, '\r\n|\r|\n') IF NOT regexp_matches(x, '^[ \t]*>')], chr(10)), '^[ \t\n]+|[ \t\n]+$', '', 'g') AS body
FROM keyed k JOIN parents p ON p.mid = k.mid JOIN tree t ON t.mid = k.mid LEFT JOIN counts c ON c.mid = k.mid
"""
