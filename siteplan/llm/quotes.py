"""Chat formatting by quotation linking.

Lines that begin with ``>`` signs are quotes; the number of signs is the level. Runs of lines of one level are passages.
Passages are normalised (words in lower case) and cut into sentences, whose hashes are joined to the first message of the
conversation that wrote such a sentence itself. A message replies to the message that wrote most of its level-1 quotes;
linked messages form threads. The result is the messages without their quotes, numbered so that a conversation runs
thread by thread and every reply stands after what it answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import lookup
from siteplan.operators.ordering import row_numbers
from siteplan.session import stage

START, MID = "\x01", "\x02"
QUOTE = r"^\s*(?:>\s?)++"  # possessive: a line may hold any number of signs
# Lines that announce a quote.
ATTRIBUTION = r"(?i)^\s*(?:on\b.*\bwrote|am\b.*\bschrieb(?:\b.*)?|le\b.*\ba [ée]crit|el\b.*\bescribi[óo])\s*:\s*$"


def level_of(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), r"\s", ""))


def passages(text: Column) -> Column:
    """Array of (level, text): runs of lines of one quote level, in order. A null text is empty."""
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), START + MID, "  "), r"\r?\n", -1)
    marked = F.transform(lines, lambda x: F.struct(level_of(x).alias("level"), F.regexp_replace(x, QUOTE, "").alias("text")))

    def joined(seen: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            starts = (i == 0) | (F.get(seen, i - 1)["level"] != x["level"])
            return F.concat(F.when(starts, F.concat(F.lit(START), x["level"].cast("string"), F.lit(MID))).otherwise(F.lit("\n")), x["text"])

        return F.array_join(F.transform(seen, piece), "")

    # The one-element array binds the lines, so that they are worked out once and not once per line.
    text_runs = F.transform(F.array(marked), joined)[0]
    runs = F.filter(F.split(text_runs, START, -1), lambda x: x != "")
    return F.transform(runs, lambda x: F.struct(F.substring_index(x, MID, 1).cast("int").alias("level"),
                                                F.substring_index(x, MID, -1).alias("text")))


def sentences(text: Column) -> Column:
    """Normalised sentences: words in lower case with single blanks. Line breaks do not matter."""
    flat = F.lower(F.regexp_replace(text, r"[\x00-\x20]+", " "))
    cut = F.transform(F.split(flat, r"[.!?]+(?: |$)", -1), lambda s: F.trim(F.regexp_replace(s, r"[^\p{L}\p{N}]+", " ")))
    return F.filter(cut, lambda s: s != "")


def parsed(messages: DataFrame, text: str = "text") -> DataFrame:
    """Add ``own`` (the text without quotes and the lines that announce them) and ``quotes`` (level, text)."""
    step = messages.withColumn("_runs", passages(F.col(text)))
    quoted = F.filter("_runs", lambda p: p["level"] > 0)
    kept = F.transform(F.filter("_runs", lambda p: p["level"] == 0), lambda p: p["text"])
    lines = F.split(F.array_join(kept, "\n"), "\n", -1)
    own = F.array_join(F.filter(lines, lambda x: ~x.rlike(ATTRIBUTION)), "\n")
    return (step.withColumn("quotes", quoted)
            .withColumn("own", F.when(F.size("quotes") > 0, F.trim(own)).otherwise(F.col(text))).drop("_runs"))


def links(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked): for messages with a linked quote. ``rows``: conv_id, turn, own, quotes.

    A quoted sentence belongs to the earliest message that wrote it itself, if that is earlier than the quote.
    reply_to needs a quote of level 1; of several originals the one with most quoted characters, then the latest.
    """
    key = ["conv_id", "turn"]
    quoted = rows.filter(F.size("quotes") > 0).select(*key, F.explode("quotes").alias("q")).select(
        *key, F.col("q.level").alias("level"), F.explode(sentences(F.col("q.text"))).alias("s"))
    quoted = quoted.select(*key, "level", F.xxhash64("s").alias("h"), F.char_length("s").alias("size")).distinct()
    wanted = quoted.select("conv_id", "h").distinct()
    wrote = (rows.select(*key, F.explode(sentences(F.coalesce("own", F.lit("")))).alias("s")).select(*key, F.xxhash64("s").alias("h"))
             .join(wanted, ["conv_id", "h"], "left_semi").groupBy("conv_id", "h").agg(F.min("turn").alias("by")))
    met = lookup(quoted, wrote, ["conv_id", "h"], [F.col("turn")], "inner").filter("by < turn")
    sums = met.groupBy(*key, "by").agg(F.sum(F.when(F.col("level") == 1, F.col("size"))).alias("size"), F.count("*").alias("n"))
    return sums.groupBy(*key).agg(F.max(F.when(F.col("size").isNotNull(), F.struct("size", "by"))).alias("best"),
                                  F.sum("n").alias("n_linked")).select(*key, F.col("best.by").alias("reply_to"), "n_linked")


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message of the thread and the number of replies up to it.

    Doubles the known stretch of every path each round, on written tables, until all ends are roots.
    """
    paths = stage(linked.filter("reply_to is not null").select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = paths.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_to"), F.col("depth").alias("_more"))
        longer = lookup(paths, up, ["conv_id", "thread"], [F.col("turn")])  # a message may have any number of replies
        if longer.filter("_to is not null").isEmpty():
            return paths
        paths = stage(longer.select("conv_id", "turn", F.coalesce("_to", "thread").alias("thread"),
                                    (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")), "threads")


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted, reply_to, thread, depth, n_quotes, n_linked, position), a row per message.

    ``text`` is the message without quotes, ``formatted`` the same with its role in chat markup, ``position`` numbers a
    conversation's messages from 1 by thread and turn, whatever its size. A message without a linked quote starts its own
    thread. Null turns come first and take part in no link; null conversation ids are one conversation without links.
    Null texts have an empty ``formatted`` body. Repeated rows each keep a row and a position.
    """
    rows = stage(parsed(messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                                        F.col("text").cast("string"))), "messages")
    found = stage(links(rows), "links")
    key = ["conv_id", "turn"]
    chain = threads(found).withColumnsRenamed({"thread": "_thread", "depth": "_depth"})
    out = (rows.join(found, key, "left").join(chain, key, "left")
           .select(*key, "role", F.col("own").alias("text"),
                   F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.coalesce("own", F.lit(""))).alias("formatted"),
                   "reply_to", F.coalesce("_thread", "turn").alias("thread"), F.coalesce("_depth", F.lit(0)).cast("long").alias("depth"),
                   F.size("quotes").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")))
    return row_numbers(out, [F.col("thread").asc(), F.col("turn").asc(), F.col("role").asc(), F.xxhash64("text").asc()], "position", ["conv_id"])
