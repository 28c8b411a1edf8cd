"""Chat formatting by quotation linking: from messages that quote each other to reply-ordered conversations.

Each message is parsed into its own lines and its quoted lines with their nesting levels. Quoted lines are
normalised and hashed, and join the messages of the thread that have the line as their own. Every quoted
line votes for the latest earlier message with it; the message with the most votes is the parent. A line
that thousands of messages share costs no pairs: the latest earlier owner is found by sorted windows
over blocks of consecutive messages, and between blocks only their maxima are compared.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestar.llm.batches import map_rows
from tidestar.session import stored

MARK = re.compile(r"[ \t]*>")
#: The line by which mail programs introduce a quotation, in the languages of the tables.
INTRODUCTION = re.compile(r"^\s*(on|am|le|el)\b.*\b(wrote|schrieb|a écrit|escribió)\s*:\s*$", re.I)
BLOCK = 1024  #: consecutive message numbers whose owners of a line are sorted together


def level_of(line: str) -> tuple[int, str]:
    """How deep a line is quoted, and the line without its marks."""
    level = 0
    while found := MARK.match(line):
        line = line[found.end() :]
        level += 1
    return level, line


def normal_hash(line: str) -> int | None:
    """The hash of a line without regard to case and spaces; none for a blank line."""
    text = " ".join(line.casefold().split())
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63 if text else None


def parse(text: str | None) -> tuple[str, list[int], list[dict[str, int]]]:
    """The text without quotes, the hashes of its lines, and each quoted line's level and hash."""
    parsed = [level_of(line) for line in (text or "").split("\n")]
    own, quoted = [], []
    for at, (level, line) in enumerate(parsed):
        if level:
            quoted.append((level, normal_hash(line)))
        elif not (at + 1 < len(parsed) and parsed[at + 1][0] and INTRODUCTION.match(line)):
            own.append(line)
    hashes = dict.fromkeys(h for h in map(normal_hash, own) if h is not None)
    quotes = dict.fromkeys(q for q in quoted if q[1] is not None)
    return "\n".join(own).strip("\n"), list(hashes), [{"level": level, "line": line} for level, line in quotes]


PARSED = "conv_id bigint, turn bigint, role string, body string, own array<bigint>, quotes array<struct<level:int,line:bigint>>"


def parsed(messages: DataFrame) -> DataFrame:
    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        def each(rows: dict[str, list]) -> dict[str, list]:
            bodies, own, quotes = zip(*map(parse, rows["text"]), strict=True)
            return {k: rows[k] for k in ("conv_id", "turn", "role")} | {"body": bodies, "own": own, "quotes": quotes}

        return each

    return map_rows(messages.select("conv_id", "turn", "role", "text"), PARSED, make)


def latest_owner(quotes: DataFrame, owners: DataFrame) -> DataFrame:
    """Of every quoted line (``conv_id``, ``line``, ``turn``) the latest earlier turn that owns it: ``owner``."""
    block = F.floor(F.col("turn") / BLOCK).alias("block")
    asked = quotes.select("conv_id", "line", "turn", block, F.lit(None).cast("bigint").alias("owned")).distinct()
    had = owners.select("conv_id", "line", "turn", block, F.col("turn").alias("owned")).distinct()
    had = had.join(quotes.select("conv_id", "line").distinct(), ["conv_id", "line"], "left_semi")
    maxima = had.groupBy("conv_id", "line", "block").agg(F.max("owned").alias("most"))
    blocks = maxima.unionByName(asked.select("conv_id", "line", "block", F.lit(None).cast("bigint").alias("most")).distinct())
    blocks = blocks.groupBy("conv_id", "line", "block").agg(F.max("most").alias("most"))
    past = Window.partitionBy("conv_id", "line").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.max("most").over(past)).drop("most")
    inside = Window.partitionBy("conv_id", "line", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = asked.unionByName(had).withColumn("near", F.max("owned").over(inside)).where("owned is null")
    found = near.join(blocks, ["conv_id", "line", "block"])
    return found.select("conv_id", "line", "turn", F.coalesce("near", "before").alias("owner")).where("owner is not null")


def parents(lines: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``parent`` of every message that quotes an earlier one; ``lines`` as ``parsed`` gives them."""
    known = lines.where("conv_id is not null and turn is not null")
    owners = known.select("conv_id", "turn", F.explode("own").alias("line"))
    quotes = known.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    found = quotes.join(latest_owner(quotes, owners), ["conv_id", "line", "turn"])
    votes = found.groupBy("conv_id", "turn", "level", "owner").agg(F.count(F.lit(1)).alias("votes"))
    # The least level that any earlier message answers to, then most votes, then the latest message.
    best = F.max_by("owner", F.struct(-F.col("level"), "votes", "owner"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("parent"))


def reply_depths(nodes: DataFrame) -> DataFrame:
    """``root`` and ``depth`` of every message, from ``conv_id``, ``turn``, ``parent``, by pointer doubling.

    A message whose pointer has come to a start is done and takes no further part, so a round costs
    what is still on its way, and their number grows with the logarithm of the depth.
    """
    up = F.coalesce("parent", "turn")
    all_of = stored(nodes.select("conv_id", "turn", up.alias("root"), (up != F.col("turn")).cast("bigint").alias("depth")), "replies")
    starts = all_of.where("depth = 0").select("conv_id", F.col("turn").alias("root"))
    done, going = all_of.where("depth = 0"), all_of.where("depth > 0")
    finished = going.join(starts, ["conv_id", "root"], "left_semi").select("conv_id", "turn", "root", "depth")
    done, going = [done, stored(finished, "replies")], stored(going.join(starts, ["conv_id", "root"], "left_anti").select("conv_id", "turn", "root", "depth"), "replies")
    while going.limit(1).count():
        known = going
        for part in done:
            known = known.unionByName(part)
        above = known.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"), F.lit(True).alias("x"))
        ends = done[0]
        for part in done[1:]:
            ends = ends.unionByName(part)
        ended = ends.select("conv_id", F.col("turn").alias("root"), F.lit(True).alias("ended"))
        step = going.join(above.drop("x"), ["conv_id", "root"]).join(ended, ["conv_id", "root"], "left")
        step = stored(step.select("conv_id", "turn", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), "ended"), "replies")
        done.append(step.where("ended").drop("ended"))
        going = step.where("ended is null").drop("ended")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def conversations(messages: DataFrame) -> DataFrame:
    """Reply-ordered conversations without quotes, from ``conv_id``, ``turn``, ``role``, ``text``.

    One row per input row: ``conv_id``, ``root`` (the turn that starts the conversation), ``depth`` (replies
    up to it), ``turn``, ``parent`` (null for a start), ``role``, ``body`` (the text without quotes)
    and ``n_quoted`` (quoted lines). Sorted by thread, root, depth and turn, each message comes after
    what it replies to. Parents are always earlier turns of the same thread. Messages that quote
    nothing known start a conversation of their own. Rows without a thread or turn link with nothing: their root is
    their turn. Null and empty texts have an empty body. Rows that repeat a turn share its place, and their
    lines count together. An empty table gives no rows; other columns are ignored.
    """
    lines = stored(parsed(messages), "lines")
    known = lines.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    nodes = stored(known.join(parents(lines), ["conv_id", "turn"], "left"), "parents")
    placed = nodes.join(reply_depths(nodes), ["conv_id", "turn"])
    out = lines.join(placed, ["conv_id", "turn"], "left")
    root, depth = F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth")
    return out.select("conv_id", root, depth, "turn", "parent", "role", "body", F.size("quotes").cast("bigint").alias("n_quoted"))


def with_quotes(turns: DataFrame) -> DataFrame:
    """Conversations as mail-like threads: each turn quotes the one it answers, and in it what that one quotes.

    A turn answers the one before it, or for a quarter of them the one before that. One row per input row. Of messages
    that repeat a turn the one of the least text is quoted. A message whose answered turn is missing, and one without a
    thread or turn, quotes nothing and starts a thread of its own. A null text that quotes nothing stays null; otherwise
    it counts as empty, as it does where it is quoted. An empty table gives no rows; other columns are ignored.
    """
    before = F.col("turn") - F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0, 2).otherwise(1)
    answered = F.when(F.col("turn") > 0, F.greatest(before, F.lit(0)))
    base = turns.select("conv_id", "turn", "role", "text", answered.alias("to"))
    single = stored(base.groupBy("conv_id", "turn", "to").agg(F.min("text").alias("text")), "turns")
    other = single.select("conv_id", F.col("turn").alias("to"), F.col("text").alias("quoted"), F.col("to").alias("to2"), F.lit(True).alias("known"))
    oldest = single.select("conv_id", F.col("turn").alias("to2"), F.col("text").alias("quoted2"))
    once = base.join(other, ["conv_id", "to"], "left").join(oldest, ["conv_id", "to2"], "left")
    marked = lambda c, mark: F.coalesce(F.concat(F.lit(mark), F.regexp_replace(c, "\n", f"\n{mark}"), F.lit("\n")), F.lit(""))
    quote = F.concat(F.lit("On Monday somebody wrote:\n"), marked(F.col("quoted2"), ">> "), marked(F.col("quoted"), "> "))
    text = F.when(F.col("known"), F.concat(quote, F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    return once.select("conv_id", "turn", "role", text.alias("text"), F.when(F.col("known"), F.col("to")).alias("answers"))
