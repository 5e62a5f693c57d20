"""Chat formatting: quoted passages are linked to the messages they come from, and threads are built without quotes."""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.merkle import numbered
from tenura.llm.texts import by_slice, row_key, stored
from tenura.session import checkpointed

MARKS = re.compile(r"^((?:[ \t]?>)+)[ \t]?")
# Lines that announce a quotation, in several languages.
ANNOUNCED = re.compile(r"^.{0,200}\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", re.IGNORECASE)
NOT_WORDS = re.compile(r"[\W_]+")
PARAGRAPHS = re.compile(r"\n[ \t]*\n")
SENTENCES = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])")


def hashed_words(text: str) -> tuple[int, int] | None:
    """The number of a passage's words and a hash of them in lower case; None without any. Line breaks, marks and punctuation do not count."""
    words = NOT_WORDS.sub(" ", text.lower()).strip()
    return (words.count(" ") + 1, xxhash.xxh3_64_intdigest(words) - (1 << 63)) if words else None


def parts(text: str) -> list[tuple[int, int]]:
    """(words, hash) of a text as a whole and of its paragraphs, lines and sentences (those of lines too), each once."""
    paragraphs, lines = PARAGRAPHS.split(text), text.split("\n")
    sentences = [x for block in (*paragraphs, *lines) for x in SENTENCES.split(block)]
    found = map(hashed_words, [text, *paragraphs, *lines, *sentences])
    return list(dict.fromkeys(f for f in found if f is not None))


def parsed(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The body without quotes, and (level, passage) of each run of lines of one quote level.

    The level counts the ``>`` before a line. A line that announces a quotation right before one (blank lines apart)
    belongs to it and leaves the body.
    """
    body: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    depth = 0
    for line in (text or "").split("\n"):
        match = MARKS.match(line)
        level = match[1].count(">") if match else 0
        if not level:
            body.append(line)
        else:
            if not depth:
                last = next((i for i in range(len(body) - 1, -1, -1) if body[i].strip()), None)
                if last is not None and ANNOUNCED.match(body[last].strip()):
                    del body[last:]
            if level != depth:
                passages.append((level, []))
            passages[-1][1].append(line[match.end() :])
        depth = level
    return "\n".join(body).strip("\n"), [(level, "\n".join(lines)) for level, lines in passages]


def own_hashes(body: str) -> list[int]:
    """Hashes under which a body can be quoted: as a whole, by paragraph, by line and by sentence."""
    return sorted({h for _, h in parts(body)})


def _messages(messages: DataFrame) -> DataFrame:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("row", pa.int64()), ("body", pa.string()),
        ("quotes", pa.list_(pa.struct([
            ("level", pa.int32()), ("parts", pa.list_(pa.struct([("words", pa.int32()), ("hash", pa.int64())]))),
        ]))), ("own", pa.list_(pa.int64())),
    ])

    def work(piece: pa.RecordBatch) -> dict[str, object]:
        bodies, quotes, own = [], [], []
        for text in piece.column("text").to_pylist():
            body, passages = parsed(text)
            found = [(level, parts(p)) for level, p in passages]
            bodies.append(body)
            quotes.append([{"level": level, "parts": [{"words": n, "hash": h} for n, h in of]} for level, of in found if of])
            own.append(own_hashes(body))
        kept = {c: piece.column(c) for c in ("conv_id", "turn", "role", "row")}
        return {**kept, "body": bodies, "quotes": quotes, "own": own}

    rows = messages.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"),
        row_key(["conv_id", "turn", "role", "text"]).alias("row"), F.col("text").cast("string"),
    )
    quoted = "array<struct<level:int,parts:array<struct<words:int,hash:bigint>>>>"
    kinds = f"conv_id bigint, turn bigint, role string, row bigint, body string, quotes {quoted}, own array<bigint>"
    return stored(rows.mapInArrow(by_slice(work, schema), kinds), "messages")


def _thread_starts(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread): pointers to earlier turns are doubled until each ends at a message that replies to none."""
    current = checkpointed(links.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("thread")))
    while True:
        up = current.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("_up"))
        moved = current.join(up, (F.col("conv_id") == F.col("_c")) & (F.col("thread") == F.col("_t")), "left")
        current = checkpointed(moved.select("conv_id", "turn", F.coalesce("_up", "thread").alias("thread"), F.col("_up").isNotNull().alias("_more")))
        if current.where("_more").isEmpty():
            return current.drop("_more")
        current = current.drop("_more")


def _reply_positions(nodes: DataFrame) -> DataFrame:
    """(conv_id, turn, position): places 0, 1, ... in each conversation, every reply behind what it answers.

    ``nodes`` are distinct (conv_id, turn, reply_to). Conversations without a reply are in order of turn. In the others
    messages are walked depth first, the branches of a message in order of turn: entering and leaving a message are two
    steps of one chain, and a step's distance to the chain's end is found by doubling, so the number of rounds is the
    logarithm of the longest conversation and no conversation meets in one task.
    """
    answered = nodes.where("reply_to IS NOT NULL").select("conv_id").distinct()
    ordered = numbered(nodes, ["conv_id", "reply_to", "turn"])
    plain = ordered.join(answered, "conv_id", "left_anti")
    first = plain.groupBy("conv_id").agg(F.min("place").alias("first"))
    straight = plain.join(first, "conv_id").select("conv_id", "turn", (F.col("place") - F.col("first")).alias("position"))
    tree = checkpointed(ordered.join(answered, "conv_id", "left_semi"))
    if tree.isEmpty():
        return straight
    # A message is named by its place; a step by twice the place, plus one when the message is left.
    parents = tree.select(F.col("conv_id"), F.col("turn").alias("reply_to"), F.col("place").alias("parent"))
    named = checkpointed(tree.join(parents, ["conv_id", "reply_to"], "left").select("conv_id", "turn", "place", "parent"))
    eldest = named.where("parent IS NOT NULL").groupBy(F.col("parent").alias("place")).agg(F.min("place").alias("child"))
    sibling = named.select(F.col("conv_id").alias("_c"), F.col("parent").alias("_p"), (F.col("place") - 1).alias("place"))
    near = named.join(eldest, "place", "left").join(sibling, "place", "left")
    beside = F.when(F.col("_c").eqNullSafe(F.col("conv_id")) & F.col("_p").eqNullSafe(F.col("parent")), 2 * (F.col("place") + 1))
    steps = near.select(F.inline(F.array(
        F.struct((2 * F.col("place")).alias("step"), F.coalesce(2 * F.col("child"), 2 * F.col("place") + 1).alias("next"), F.lit(1).cast("bigint").alias("left")),
        F.struct((2 * F.col("place") + 1).alias("step"), F.coalesce(beside, 2 * F.col("parent") + 1).alias("next"), F.lit(0).cast("bigint").alias("left")),
    )))
    current = checkpointed(steps)
    while not current.where("next IS NOT NULL").isEmpty():
        ahead = current.select(F.col("step").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        moved = current.join(ahead, "next", "left")
        current = checkpointed(moved.select("step", F.col("_next").alias("next"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left")))
    entered = current.where("step % 2 = 0").select(F.expr("step div 2").alias("place"), "left")
    reached = named.join(entered, "place")
    whole = named.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    walked = reached.join(whole, "conv_id").select("conv_id", "turn", (F.col("_n") - F.col("left")).alias("position"))
    return straight.unionByName(walked)


def linked_messages(messages: DataFrame) -> DataFrame:
    """One row per input row: conv_id, turn, role, n_quotes, n_linked, reply_to, origin_conv, origin_turn, thread, position and body.

    A quoted passage (a run of lines of one level) is hashed as a whole, by paragraph, line and sentence, and so are all
    messages' own texts. The parts are joined by hash to the first message that has them: an earlier one of the same
    conversation if there is one, else the first of all other conversations. A passage is linked by its longest part
    (in words, then in order) that any message has; a piece of a line that is no whole sentence is no part.
    ``reply_to`` is the latest turn among the linked passages of the lowest level in the same conversation, ``origin_*``
    the message behind the first passage that is linked to another conversation. ``thread`` is the turn that a chain of
    replies starts from. Ordering a conversation by ``position`` gives its messages depth first: each behind what it
    answers, before the next branch; rows that share a turn share its position.

    Hashes of own passages are reduced to one row a conversation, and one in all, before the join, so common lines and
    long conversations bring no more. NULL and empty texts have an empty body and no quotes. Rows with a NULL conv_id or
    turn are never linked and have no position. Repeated rows give repeated results; an empty table gives none; other columns are ignored.
    """
    rows = _messages(messages)
    own = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode("own").alias("hash"))
    here = own.groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))
    firsts = own.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("origin"))
    quotes = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "row", F.posexplode("quotes").alias("n", "q"))
    quotes = quotes.select("conv_id", "turn", "row", "n", "q.level", F.posexplode("q.parts").alias("place", "part"))
    quotes = checkpointed(quotes.select("conv_id", "turn", "row", "n", "level", "place", "part.words", "part.hash").distinct())
    wanted = quotes.select("hash").distinct()
    near = here.join(wanted, "hash", "left_semi").withColumnsRenamed({"conv_id": "_c", "hash": "_h"})
    anywhere = firsts.join(wanted, "hash", "left_semi").withColumnRenamed("hash", "_g")
    joined = quotes.join(near, (F.col("conv_id") == F.col("_c")) & (F.col("hash") == F.col("_h")), "left").join(
        anywhere, F.col("hash") == F.col("_g"), "left"
    )
    inside = F.when(F.col("first") < F.col("turn"), F.col("first"))
    outside = F.when(inside.isNull() & (F.col("origin.conv_id") != F.col("conv_id")), F.col("origin"))
    linked = joined.select("conv_id", "turn", "row", "n", "level", "words", "place", inside.alias("inside"), outside.alias("outside"))
    known = F.col("inside").isNotNull() | F.col("outside").isNotNull()
    longest = F.min(F.when(known, F.struct((-F.col("words")).alias("back"), "place", "inside", "outside")))
    links = checkpointed(
        linked.groupBy("conv_id", "turn", "row", "n", "level").agg(longest.alias("_l"))
        .select("conv_id", "turn", "row", "n", "level", "_l.inside", "_l.outside")
    )
    by_message = links.groupBy("conv_id", "turn", "row").agg(
        F.count(F.lit(1)).alias("n_quotes"),
        F.count_if(F.col("inside").isNotNull() | F.col("outside").isNotNull()).alias("n_linked"),
        F.min(F.when(F.col("inside").isNotNull(), F.struct("level", (-F.col("inside")).alias("back")))).alias("_in"),
        F.min(F.when(F.col("outside").isNotNull(), F.struct("n", "outside"))).alias("_out"),
    )
    by_message = checkpointed(
        by_message.select(
            "conv_id", "turn", "row", "n_quotes", "n_linked", (-F.col("_in.back")).alias("reply_to"),
            F.col("_out.outside.conv_id").alias("origin_conv"), F.col("_out.outside.turn").alias("origin_turn"),
        )
    )
    starts = _thread_starts(by_message.where("reply_to IS NOT NULL"))
    found = by_message.join(starts, ["conv_id", "turn"], "left").withColumnsRenamed({"conv_id": "_c", "turn": "_t", "row": "_r"})
    same = (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")) & (F.col("row") == F.col("_r"))
    replies = by_message.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("reply_to"))
    nodes = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct().join(replies, ["conv_id", "turn"], "left")
    places = _reply_positions(checkpointed(nodes)).withColumnsRenamed({"conv_id": "_pc", "turn": "_pt"})
    at = (F.col("conv_id") == F.col("_pc")) & (F.col("turn") == F.col("_pt"))
    return rows.join(found, same, "left").join(places, at, "left").select(
        "conv_id", "turn", "role", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_to", "origin_conv", "origin_turn", F.coalesce("thread", "turn").alias("thread"), "position", "body",
    )
