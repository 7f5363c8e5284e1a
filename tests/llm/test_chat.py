import hashlib
import random

from barflow.llm import chat, queries

ROWS = "conv_id long, turn long, role string, text string, place string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = chat.markdown_turns([(r, t) for _, r, t in turns])
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), len(whole))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect()}


def made():
    r = random.Random(8)
    bits = ["\\", "###", "#", "</turn>", "<", "/", "assistant", ":\n", "\n", "é", "😀", "a ", "b", "n"]
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system"]), "".join(r.choice(bits) for _ in range(r.randint(0, 12))))
            for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t} ") for t in range(200)]
    rows += [(101, 0, None, None), (101, 0, None, None), (101, None, "assistant", "x"), (None, 1, "assistant", "y"),
             (102, 1, "a\nb:\n\\n", "z"), (103, 1, "assistant", "w " * 300_000)]
    return rows


def test_against_plain_rendering(spark):
    rows = made()
    df = spark.createDataFrame([(*x, "clash") for x in rows], ROWS).repartition(4)
    pieces = chat.format_turns(df).cache()
    none_first = [(c, -1 if t is None else t, r, x) for c, t, r, x in rows]
    assert chat.unstable(pieces).count() == 0 and got(chat.digest(pieces)) == expected(none_first)
    assert chat.format_turns(df.limit(0)).count() == 0 and chat.digest(chat.format_turns(df.limit(0))).count() == 0


def test_escape_is_reversible():
    for _, _, role, text in made():
        assert chat.unescape(chat.escape(text or "")) == (text or "")
        assert chat.parse(chat.markdown_turns([(role or "", text or "")])) == (role or "", text or "")


def test_templates_that_rewrite_or_look_back_are_found(spark):
    df = spark.createDataFrame([(1, t, ("user", "assistant")[t % 2], f"t{t}", "x") for t in range(40)], ROWS)

    def drops_old_answers(turns):
        return "".join(f"<{r}>{'...' if r == 'assistant' and i < len(turns) - 1 else t}" for i, (r, t) in enumerate(turns))

    def counts_back(turns):
        return "".join(f"[{i if i < 8 else 'late'}]{t}" for i, (r, t) in enumerate(turns))
    assert chat.unstable(chat.format_turns(df, drops_old_answers)).count() > 0
    assert chat.unstable(chat.format_turns(df, counts_back)).count() > 0
    text = chat.format_turns(df, lambda turns: "".join(f"{r}|{t}|" for r, t in turns)).filter("core").orderBy("place").collect()
    assert [r.formatted[r.loss_start:r.loss_stop] for r in text if r.loss_start is not None] == [f"t{t}" for t in range(1, 40, 2)]


def test_a_template_that_changes_its_mind_late_is_found(spark):
    """The first answer goes once there are more than 20 turns: no block has that many."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"t{t}", "x") for c, n in ((1, 40), (2, 12), (None, 30)) for t in range(n)]
    df = spark.createDataFrame([*rows, (3, 0, None, None, "x")], ROWS)

    def drops_late(turns):
        return "".join(f"<{r}>{'' if i == 1 and len(turns) > 20 else t}" for i, (r, t) in enumerate(turns))

    def same(render, **most):
        return {r.conv_id: (r.n_turns, r.same) for r in chat.against_whole(df, chat.format_turns(df, render), render, **most).collect()}
    assert chat.unstable(chat.format_turns(df, drops_late)).count() == 0
    assert same(drops_late) == {1: (40, False), 2: (12, True), None: (30, False), 3: (1, True)}
    assert same(chat.markdown_turns) == {1: (40, True), 2: (12, True), None: (30, True), 3: (1, True)}
    assert same(drops_late, most_turns=35) == {1: (40, None), 2: (12, True), None: (30, False), 3: (1, True)}
    assert same(drops_late, most_chars=50)[1] == (40, None)
    empty = df.limit(0)
    assert chat.against_whole(empty, chat.format_turns(empty)).count() == 0


def test_registered(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, d, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert got(queries.op10_chat(spark, d)) == expected(rows)
