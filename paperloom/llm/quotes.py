"""Quotation linking: which earlier message does a message quote, and what does it say itself?

All of it is DataFrame operations. Quoted lines and paragraphs are compared by hash with the
first message of the conversation that said them in its own words; that first message is a
minimum, computed on the map side first, so a phrase that a third of all messages repeat is one
row. Threads follow from the links by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, unused, written

# Marks at the start of a line, each with an optional blank after it.
_MARKS = r"^(?:[ \t]?>)+"
_SENTENCE_END = r"[.!?…]+[^\p{L}\p{N}.!?…]*(?:\s|$)|[。！？]+"
WINDOW = 6  # words of an excerpt that is no sentence
_ATTRIBUTION = r"(?i)^\s*on\s.*\swrote:\s*$"


def _level(line: Column) -> Column:
    """Number of quote marks in front of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def _normal(text: Column) -> Column:
    """Letters and digits in lower case, one blank between words."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    return F.trim(plain)


def parse_quotes(messages: DataFrame, text: str = "text") -> DataFrame:
    """Adds `lines`: array of structs level, line (without marks), in order.

    A line that introduces a quotation ("On … wrote:") gets level -1.
    """
    raw = F.split(column(text), "\r?\n", -1)
    levels = F.transform(raw, lambda x: F.struct(_level(x).alias("level"), x.alias("line")))

    def clean(item: Column, i: Column) -> Column:
        following = F.get(levels, i + 1)["level"]
        introduces = (item["level"] == 0) & item["line"].rlike(_ATTRIBUTION) & (following > 0)
        return F.struct(
            F.when(introduces, -1).otherwise(item["level"]).alias("level"),
            F.regexp_replace(item["line"], _MARKS, "").alias("line"),
        )

    return messages.withColumn("lines", F.transform(levels, clean))


def _excerpts(text: Column) -> Column:
    """The sentences of a paragraph and all its runs of WINDOW words, wherever lines break."""
    sentences = F.transform(F.split(F.regexp_replace(text, r"\s+", " "), _SENTENCE_END), _normal)
    words = F.split(_normal(text), " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - WINDOW + 1, F.lit(1)))
    windows = F.transform(starts, lambda i: F.array_join(F.slice(words, i, WINDOW), " "))
    return F.concat(sentences, windows)


def passages(parsed: DataFrame, excerpts: bool = False) -> DataFrame:
    """What each message says or quotes, as hashes: conv, turn, level, unit, weight.

    Units are lines, and paragraphs (runs of lines of one level between blank lines), which
    match also where a reader's program has broken lines anew. A unit without letters or
    digits is left out. weight is its length. With `excerpts` units are parts of paragraphs
    instead: sentences and runs of words.
    """
    start = F.struct(F.lit(-2).alias("level"), F.lit("").alias("text"))
    empty = F.array(start)

    def add(done: Column, item: Column) -> Column:
        last = F.element_at(done, -1)
        blank = F.trim(item["line"]) == ""
        joined = F.struct(
            last["level"].alias("level"),
            F.concat(last["text"], F.lit("\n"), item["line"]).alias("text"),
        )
        new = F.struct(
            F.when(blank, -2).otherwise(item["level"]).alias("level"), item["line"].alias("text")
        )
        front = F.slice(done, 1, F.size(done) - 1)
        return F.when(
            ~blank & (last["level"] == item["level"]), F.concat(front, F.array(joined))
        ).otherwise(F.concat(done, F.array(new)))

    has_quotes = F.exists("lines", lambda x: x["level"] > 0)
    paragraphs = F.aggregate("lines", empty, add)
    single = F.transform(
        "lines", lambda x: F.struct(x["level"].alias("level"), x["line"].alias("text"))
    )
    if excerpts:
        runs = F.filter(paragraphs, lambda x: x["level"] >= 0)
        found = F.flatten(
            F.transform(
                runs,
                lambda x: F.transform(
                    _excerpts(x["text"]),
                    lambda t: F.struct(x["level"].alias("level"), t.alias("text")),
                ),
            )
        )
    else:
        found = F.transform(
            F.concat(single, paragraphs),
            lambda x: F.struct(x["level"].alias("level"), _normal(x["text"]).alias("text")),
        )
    units = F.array_distinct(found)
    return (
        parsed.select("conv", "turn", has_quotes.alias("has_quotes"), F.inline(units))
        .filter((F.col("level") >= 0) & (F.col("text") != ""))
        .select(
            "conv",
            "turn",
            "level",
            F.xxhash64("text").alias("unit"),
            F.length("text").alias("weight"),
        )
    )


def link_quotes(units: DataFrame) -> DataFrame:
    """For each message and quote level the earlier message most of whose words it quotes.

    Returns conv, turn, level, source_turn, weight (characters matched). The source of a unit is
    the first message of the conversation that has it in its own words, if that is an earlier
    one. Ties go to the later source.
    """
    quoted = units.filter(F.col("level") > 0)
    # Only what somebody quotes has to be looked for.
    wanted = quoted.select("conv", "unit").distinct()
    said = (
        units.filter(F.col("level") == 0)
        .groupBy("conv", "unit")
        .agg(F.min("turn").alias("source_turn"))
        .join(wanted, ["conv", "unit"], "left_semi")
    )
    matched = (
        quoted.join(said, ["conv", "unit"])
        .filter(F.col("source_turn") < F.col("turn"))
        .groupBy("conv", "turn", "level", "source_turn")
        .agg(F.sum("weight").alias("weight"))
    )
    best = F.max(F.struct("weight", "source_turn")).alias("best")
    return (
        matched.groupBy("conv", "turn", "level")
        .agg(best)
        .select("conv", "turn", "level", "best.source_turn", "best.weight")
    )


def _with_excerpts(parsed: DataFrame, units: DataFrame, links: DataFrame) -> DataFrame:
    """`links`, and those of quotations without one that are excerpts of an earlier message."""
    at = ["conv", "turn", "level"]
    quoted = units.filter(F.col("level") > 0).select(*at).distinct()
    unlinked = written(quoted.join(links, at, "left_anti"), "quotes-unlinked")
    if unlinked.isEmpty():
        return links
    talks = parsed.join(unlinked.select("conv").distinct(), "conv", "left_semi")
    parts = passages(talks, excerpts=True)
    asked = parts.filter(F.col("level") > 0).join(unlinked, at, "left_semi")
    own = parts.filter(F.col("level") == 0)
    found = link_quotes(own.unionByName(asked.select(*own.columns)))
    return written(links.unionByName(found), "quote-links")


def thread_roots(parents: DataFrame) -> DataFrame:
    """conv, turn, parent -> conv, turn, root, depth, by pointer doubling.

    Parents are earlier turns, so there are no cycles, and as many rounds as the logarithm of
    the longest chain of replies.
    """
    at = written(
        parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")),
        "threads",
    )
    while True:
        above = at.select(
            "conv",
            F.col("turn").alias("root"),
            F.col("root").alias("next"),
            F.col("depth").alias("more"),
        )
        moved = at.join(above, ["conv", "root"], "left")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return at
        at = written(
            moved.select(
                "conv",
                "turn",
                F.coalesce("next", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "threads",
        )


def reply_ordered(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
) -> DataFrame:
    """Messages without quotations, linked to the messages they quote.

    All columns of `messages` are kept, but for the text, which loses its quoted lines, the
    lines that introduce them, and blank lines at its ends. Added columns:

    - reply_turn: the turn quoted at level 1, null without one;
    - quote_levels: the deepest level of quoting; n_quoted: number of quoted lines;
      n_linked: at how many levels an original was found;
    - thread_turn: the first message of the chain of replies, itself without a link;
      reply_depth: replies between that one and this.

    Sorted by conversation, thread_turn and turn, every message stands behind the one it
    answers. A quotation is looked for as whole lines and paragraphs; if none is found, as
    sentences and runs of WINDOW words. A message without conversation or turn is not linked; its thread_turn is its turn.
    A null text stays null. Rows that share conversation and turn count as one message for
    links; all of them are kept. An empty table gives an empty one.
    """
    names = ["reply_turn", "quote_levels", "n_quoted", "n_linked", "thread_turn", "reply_depth"]
    messages = messages.drop(*names)
    work, source, drop_lines = unused(messages, "conv"), unused(messages, "at"), "lines"
    narrow = messages.select(
        column(conv).alias("conv"), column(turn).alias("turn"), column(text).alias("text")
    )
    known_rows = parse_quotes(narrow).filter("conv IS NOT NULL AND turn IS NOT NULL")
    units = passages(known_rows)
    links = _with_excerpts(known_rows, units, written(link_quotes(units), "quote-links"))
    roots = thread_roots(links.filter("level = 1").withColumnRenamed("source_turn", "parent"))
    by_message = links.groupBy("conv", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("source_turn"))).alias("reply_turn"),
        F.count(F.lit(1)).alias("n_linked"),
    )
    known = by_message.join(
        roots.select(
            "conv", "turn", F.col("root").alias("thread_turn"), F.col("depth").alias("reply_depth")
        ),
        ["conv", "turn"],
        "left",
    ).withColumnsRenamed({"conv": work, "turn": source})
    own = unused(messages, drop_lines)
    parsed = parse_quotes(messages.withColumnRenamed("lines", own) if own != "lines" else messages, text)
    joined = parsed.join(
        known,
        (column(conv) == F.col(work)) & (column(turn) == F.col(source)),
        "left",
    )
    lines = F.col("lines")
    body = F.array_join(
        F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["line"]), "\n"
    )
    quotes = F.exists(lines, lambda x: x["level"] > 0)
    deepest = F.greatest(F.array_max(F.transform(lines, lambda x: x["level"])), F.lit(0))
    out = joined.withColumns(
        {
            "quote_levels": F.coalesce(deepest, F.lit(0)).cast("int"),
            "n_quoted": F.coalesce(
                F.size(F.filter(lines, lambda x: x["level"] > 0)), F.lit(0)
            ).cast("bigint"),
            "n_linked": F.coalesce("n_linked", F.lit(0)).cast("bigint"),
            "thread_turn": F.coalesce(F.col("thread_turn"), column(turn)),
            "reply_depth": F.coalesce("reply_depth", F.lit(0)).cast("int"),
            text: F.when(
                quotes, F.regexp_replace(body, r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")
            ).otherwise(column(text)),
        }
    ).drop(work, source, "lines")
    if own != "lines":
        out = out.withColumnRenamed(own, "lines")
    return out.select(*[column(c) for c in messages.columns], *names)


SQL = r"""
    WITH RECURSIVE raw AS (
      SELECT conv_id, turn, unnest(string_split_regex(text, '\r?\n')) AS line,
        generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS pos
      FROM conversations),
    leveled AS (
      SELECT conv_id, turn, pos, line,
        length(regexp_replace(regexp_extract(line, '^(?:[ \t]?>)+'), '[^>]', '', 'g')) AS level
      FROM raw),
    lines AS (
      SELECT conv_id, turn, pos, regexp_replace(line, '^(?:[ \t]?>)+', '') AS line,
        CASE WHEN level = 0 AND regexp_matches(line, '(?i)^\s*on\s.*\swrote:\s*$')
            AND coalesce(lead(level) OVER (PARTITION BY conv_id, turn ORDER BY pos), 0) > 0
          THEN -1 ELSE level END AS level
      FROM leveled),
    runs AS (
      SELECT *, pos - row_number() OVER (
          PARTITION BY conv_id, turn, level, trim(line) = '' ORDER BY pos) AS run
      FROM lines),
    texts AS (
      SELECT conv_id, turn, level, line AS text FROM lines
      UNION ALL
      SELECT conv_id, turn, level, string_agg(line, chr(10) ORDER BY pos) FROM runs
      WHERE trim(line) <> '' GROUP BY conv_id, turn, level, run),
    units AS (
      SELECT DISTINCT conv_id, turn, level,
        trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS unit
      FROM texts WHERE level >= 0),
    said AS (
      SELECT conv_id, unit, min(turn) AS source_turn FROM units
      WHERE level = 0 AND unit <> '' GROUP BY conv_id, unit),
    matched AS (
      SELECT u.conv_id, u.turn, u.level, s.source_turn, sum(length(u.unit)) AS weight
      FROM units u JOIN said s ON u.conv_id = s.conv_id AND u.unit = s.unit
      WHERE u.level > 0 AND s.source_turn < u.turn GROUP BY ALL),
    links AS (
      SELECT conv_id, turn, level, source_turn FROM matched
      QUALIFY row_number() OVER (
        PARTITION BY conv_id, turn, level ORDER BY weight DESC, source_turn DESC) = 1),
    chains AS (
      SELECT conv_id, turn, source_turn AS root, 1 AS depth FROM links WHERE level = 1
      UNION ALL
      SELECT c.conv_id, c.turn, l.source_turn, c.depth + 1
      FROM chains c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root AND l.level = 1),
    bodies AS (
      SELECT conv_id, turn, greatest(max(level), 0) AS quote_levels,
        count(*) FILTER (level > 0) AS n_quoted,
        regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ''),
          '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') AS body
      FROM lines GROUP BY conv_id, turn)
    SELECT m.conv_id, m.turn, m.role,
      (SELECT max(source_turn) FROM links l
        WHERE l.conv_id = m.conv_id AND l.turn = m.turn AND l.level = 1) AS reply_turn,
      CAST(coalesce(b.quote_levels, 0) AS INTEGER) AS quote_levels,
      coalesce(b.n_quoted, 0) AS n_quoted,
      (SELECT count(*) FROM links l WHERE l.conv_id = m.conv_id AND l.turn = m.turn) AS n_linked,
      coalesce((SELECT min(root) FROM chains c
        WHERE c.conv_id = m.conv_id AND c.turn = m.turn), m.turn) AS thread_turn,
      CAST(coalesce((SELECT max(depth) FROM chains c
        WHERE c.conv_id = m.conv_id AND c.turn = m.turn), 0) AS INTEGER) AS reply_depth,
      CASE WHEN b.n_quoted > 0 THEN b.body ELSE m.text END AS text
    FROM conversations m LEFT JOIN bodies b ON b.conv_id = m.conv_id AND b.turn = m.turn"""
