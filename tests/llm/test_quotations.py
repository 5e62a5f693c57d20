import random
import re

from tenura.llm.quotations import linked_messages, parsed

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_levels_and_announcements():
    body, quotes = parsed("Hello\n\nOn Monday Ann wrote:\n> one\n> two\n> > deep\n>> deeper\n> three\nmy answer")
    assert body == "Hello\n\nmy answer"
    assert quotes == [(1, "one\ntwo"), (2, "deep\ndeeper"), (1, "three")]
    assert parsed("a > b\nAnn wrote:\nplain") == ("a > b\nAnn wrote:\nplain", [])
    assert parsed(None) == ("", []) and parsed(">") == ("", [(1, "")])


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS thread", "'x' AS body", "2 AS hash", "3 AS row")
    return {(r.conv_id, r.turn, r.role): r for r in linked_messages(df).collect()}


def test_replies_follow_what_they_quote(spark):
    rows = [
        (1, 0, "a", "How do I open a file?\nAnd how do I close it?"), (1, 1, "b", "Use open()."), (1, 2, "c", "Something else."),
        (1, 3, "a", "b wrote:\n> Use OPEN ( )\nThanks!"), (1, 4, "b", "> Thanks!\n>> Use open().\nWelcome."),
        (1, 5, "c", "> and how do I\n> close it?\nWith close."), (1, 6, "d", "> never said\nHm."),
        (2, 0, "a", "> Something else.\nWhat?"), (2, 1, "a", "> what\nYes."), (2, 2, "a", None), (None, None, None, "> Thanks!"),
    ]
    r = found(spark, rows)
    assert len(r) == len(rows)
    first = r[1, 3, "a"]
    assert (first.n_quotes, first.n_linked, first.reply_to, first.thread, first.body) == (1, 1, 1, 1, "Thanks!")
    second = r[1, 4, "b"]
    assert (second.n_quotes, second.n_linked, second.reply_to, second.thread) == (2, 2, 3, 1)
    assert (r[1, 5, "c"].reply_to, r[1, 5, "c"].thread) == (0, 0)
    assert (r[1, 6, "d"].n_quotes, r[1, 6, "d"].n_linked, r[1, 6, "d"].reply_to, r[1, 6, "d"].thread) == (1, 0, None, 6)
    assert (r[2, 0, "a"].origin_conv, r[2, 0, "a"].origin_turn, r[2, 0, "a"].reply_to) == (1, 2, None)
    assert r[2, 2, "a"].body == "" and r[None, None, None].n_quotes == 0
    order = sorted((x for x in r.values() if x.conv_id == 1), key=lambda x: x.position)
    assert [x.turn for x in order] == [0, 5, 1, 3, 4, 2, 6] and [x.position for x in order] == list(range(7))
    assert [r[2, i, "a"].position for i in range(3)] == [0, 1, 2] and r[None, None, None].position is None


def test_parts_of_a_message_are_linked(spark):
    original = "Roses are red\nviolets are blue\nsugar is sweet\n\nA second thought. It has two sentences! And a third one?\n\nThe last paragraph."
    texts = [
        original, "Something of no interest.",
        "> violets are blue\n> sugar is sweet\nTwo lines.",
        "> A second thought. It has two sentences! And a third one?\n>\n> The last paragraph.\nTwo paragraphs.",
        "> It has two sentences!\nOne sentence.",
        "> Roses are red\nsplit\n> violets are blue\n> sugar is sweet\nby a reply.",
        "> A second thought. It has\n> two sentences!\nWrapped anew.",
        "> never said\n> The last paragraph.\nIn part.",
        "> never said\n> by anyone\nNothing.",
    ]
    r = found(spark, [(1, i, "u", t) for i, t in enumerate(texts)] + [(2, 0, "u", texts[2])])
    linked = {t: (x.n_quotes, x.n_linked, x.reply_to) for (c, t, _), x in r.items() if c == 1}
    assert [linked[i] for i in (2, 3, 4, 6, 7)] == [(1, 1, 0)] * 5
    assert linked[5] == (2, 2, 0) and linked[8] == (1, 0, None)
    assert (r[2, 0, "u"].origin_conv, r[2, 0, "u"].origin_turn, r[2, 0, "u"].n_linked) == (1, 0, 1)


def test_the_longest_part_decides(spark):
    rows = [(1, 0, "u", "Yes."), (1, 1, "u", "Water boils at a hundred degrees. Mostly."), (1, 2, "u", "> Yes.\n> Water boils at a hundred degrees.\nI see.")]
    assert found(spark, rows)[1, 2, "u"].reply_to == 1


def test_long_chains_and_repeated_rows(spark):
    rows = [(1, 0, "u", "start 0")] + [(1, i, "u", f"> start {i - 1}\nstart {i}") for i in range(1, 70)]
    rows += [(1, 69, "u", "> start 68\nstart 69")] * 2
    r = spark.createDataFrame(rows, SCHEMA)
    out = linked_messages(r).collect()
    assert len(out) == len(rows) and {x.thread for x in out} == {0}


def test_empty_table(spark):
    assert linked_messages(spark.createDataFrame([], SCHEMA)).count() == 0


# Brute force: every quoted part is compared with every part of every message as plain words, and replies are walked by
# recursion. Levels and bodies are parsed line by line here as well.


def words(text):
    return " ".join(re.sub(r"[\W_]+", " ", text.lower()).split())


def all_parts(text):
    blocks = [*re.split(r"\n[ \t]*\n", text), *text.split("\n")]
    sentences = [x for b in blocks for x in re.split(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])", b)]
    out = []
    for part in [text, *blocks, *sentences]:
        if words(part) and words(part) not in out:
            out.append(words(part))
    return out


def plain_parse(text):
    body, runs, before = [], [], 0
    for line in (text or "").split("\n"):
        marks = re.match(r"((?:[ \t]?>)*)[ \t]?", line)
        level = marks[1].count(">")
        if level and level != before:
            if not before:
                kept = [i for i, x in enumerate(body) if x.strip()]
                if kept and re.search(r"\b(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", body[kept[-1]].strip(), re.I):
                    body = body[: kept[-1]]
            runs.append((level, []))
        (runs[-1][1] if level else body).append(line[len(marks[0]) :] if level else line)
        before = level
    return "\n".join(body).strip("\n"), [(level, "\n".join(lines)) for level, lines in runs if words("\n".join(lines))]


def brute(rows):
    known = {(c, t): plain_parse(x) for c, t, _, x in rows}
    own = {at: all_parts(body) for at, (body, _) in known.items()}
    facts, parent = {}, {}
    for (c, t), (_, runs) in known.items():
        linked, inner, outer = 0, [], []
        for n, (level, passage) in enumerate(runs):
            best = None
            for place, part in enumerate(all_parts(passage)):
                here = sorted(u for (d, u), parts in own.items() if d == c and part in parts)
                everywhere = sorted(at for at, parts in own.items() if part in parts)
                target = None
                if here and here[0] < t:
                    target = ("in", here[0])
                elif everywhere and everywhere[0][0] != c:
                    target = ("out", everywhere[0])
                if target and (best is None or (-len(part.split()), place) < best[0]):
                    best = ((-len(part.split()), place), target)
            if best:
                linked += 1
                (inner.append((level, -best[1][1])) if best[1][0] == "in" else outer.append((n, best[1][1])))
        parent[c, t] = -min(inner)[1] if inner else None
        facts[c, t] = (len(runs), linked, parent[c, t], min(outer)[1] if outer else (None, None))
    position = {}
    for c in {c for c, _ in known}:
        todo = sorted((t for d, t in known if d == c and parent[d, t] is None), reverse=True)
        while todo:
            t = todo.pop()
            position[c, t] = sum(d == c for d, _ in position)
            todo += sorted((u for d, u in known if d == c and parent[d, u] == t), reverse=True)
    return {at: (*f[:3], *f[3], position[at], known[at][0]) for at, f in facts.items()}


def generated(seed):
    """Conversations whose messages quote whole, nested, wrapped anew, in part, or from another conversation."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def sentence():
        return " ".join(draw.choices(vocabulary, k=draw.randint(3, 9))).capitalize() + draw.choice(".!?")

    rows = []
    for c in range(6):
        texts = []
        for t in range(draw.randint(1, 14)):
            body = "\n\n".join("\n".join(sentence() for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(1, 2)))
            if texts and draw.random() < 0.7:
                source = draw.choice(texts)
                kind = draw.choice(["whole", "nested", "wrapped", "line", "sentence", "other", "part", "unknown"])
                plain = plain_parse(source)[0]
                if kind == "other" and rows:
                    plain = plain_parse(draw.choice(rows)[3])[0]
                if kind == "nested":
                    plain = source
                elif kind == "wrapped":
                    tokens = plain.split()
                    plain = "\n".join(" ".join(tokens[i : i + 4]) for i in range(0, len(tokens), 4))
                elif kind == "line":
                    plain = draw.choice(plain.split("\n"))
                elif kind == "sentence":
                    plain = draw.choice(re.split(r"(?<=[.!?])\s+", plain))
                elif kind == "part":
                    plain = plain.rsplit(" ", 1)[0]
                elif kind == "unknown":
                    plain = sentence()
                quoted = "\n".join(("> " if draw.random() < 0.8 else ">") + x for x in plain.split("\n"))
                body = draw.choice(["", "Ann wrote:\n", "On Monday Bob said:\n\n"]) + quoted + "\n" + body
            texts.append(body)
            rows.append((c, t, "u", body))
    return rows


def test_against_brute_force(spark):
    for seed in (1, 2, 3):
        rows = generated(seed)
        out = found(spark, rows)
        got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to, r.origin_conv, r.origin_turn, r.position, r.body) for r in out.values()}
        expected = brute(rows)
        assert got == expected
        assert any(x[2] is not None for x in expected.values()) and any(x[3] is not None for x in expected.values())


def test_branches_in_reply_order(spark):
    rows = [(1, 0, "u", "root one"), (1, 1, "u", "root two"), (1, 2, "u", "> root one\nfirst answer"), (1, 3, "u", "> root two\nsecond answer"),
            (1, 4, "u", "> first answer\ndeep answer"), (1, 5, "u", "> root one\nthird answer"), (1, 6, "u", "> second answer\nlast one")]
    rows += [(2, t, "u", f"alone {t}") for t in (5, 3, 9)]
    out = found(spark, rows)
    order = sorted((r.position, r.turn) for r in out.values() if r.conv_id == 1)
    assert order == list(enumerate([0, 2, 4, 5, 1, 3, 6]))
    assert sorted((r.position, r.turn) for r in out.values() if r.conv_id == 2) == [(0, 3), (1, 5), (2, 9)]


def test_very_long_texts_and_one_large_conversation(spark):
    long = "\n".join(f"line {i} of a long text." for i in range(20_000))
    rows = [(1, 0, "u", long), (1, 1, "u", "> line 19999 of a long text.\nyes"), (1, 2, "u", "\n".join(">" * (1 + i % 300) + f" q{i}" for i in range(3_000)))]
    rows += [(2, t, "u", f"m{t}" if t % 3 else f"> m{t - 1}\nm{t}") for t in range(1, 700)]
    out = found(spark, rows)
    assert out[1, 1, "u"].reply_to == 0 and out[1, 2, "u"].n_quotes == 3_000
    places = sorted((r.position, r.turn, r.reply_to) for r in out.values() if r.conv_id == 2)
    assert [p for p, *_ in places] == list(range(699))
    at = {t: p for p, t, _ in places}
    assert all(at[t] == at[up] + 1 for _, t, up in places if up is not None)
