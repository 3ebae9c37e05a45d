import hashlib
import random

from pyspark.sql import functions as F

from brickfolio.llm.chat import PART, digests, format_messages, read_loss, read_turns, report

NASTY = ["", None, "\\", "\\l", "\\e\\b", "</s>", "[TURN]", "[TURN]assistant\nhi</s>", "<|image|>", "a\nb\n", "é\U0001F600<[\\", "<", "[", "\\\\l<", "|>", "<|"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_any_text_comes_back(spark):
    rng = random.Random(1)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a\nb", "[TURN]", None]), "".join(x or "" for x in rng.choices(NASTY, k=rng.randint(0, 4))) if rng.random() < 0.9 else None))
    rows.append((None, None, None, None))
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, formatted string").repartition(3)
    got = {r.conv_id: r for r in report(frame).collect()}
    want = {}
    for c, t, role, text in [*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]:
        want.setdefault(c, []).append((t or 0, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda x: x[0])
        learnt = "".join(x[2] for x in turns if x[1] == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))
    assert [r.conv_id for r in report(frame.limit(0)).collect()] == [-1]


def test_parts_become_placeholders_in_order(spark):
    p = lambda **k: tuple(k.get(n.split()[0]) for n in PART.split(", "))
    rows = [
        (1, 0, "user", [p(type="text", text="see <|image|> here: "), p(type="image", ref="a.png", width=60, height=28), None, p(type="text", text=" and "), p(type="audio", ref="b.wav", seconds=1.5)]),
        (1, 1, "assistant", [p(type="text", text="a [TURN]"), p(type="video", ref="c"), p(type="text", text=None)]),
        (1, 2, "user", [p(type="document", ref="d.pdf", pages=2), p(type="image", ref="e")]), (2, 0, "assistant", None), (2, 1, "user", [])]
    frame = spark.createDataFrame(rows, f"conv_id int, turn int, role string, content array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>")
    done = format_messages(frame)
    one, two = sorted(done.select("*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("learnt")).collect(), key=lambda r: r.conv_id)
    assert [tuple(a) for a in one.attachments] == [(1, 0, "image", "a.png", 3), (1, 1, "audio", "b.wav", 38), (2, 0, "attachment", "c", 1), (3, 0, "document", "d.pdf", 1200), (3, 1, "image", "e", 1)]
    assert one.n_tokens == 3 + 38 + 1 + 1200 + 1 + -(-20 // 4) + 2 + 2
    assert [[(x.type, x.text) for x in t.parts] for t in one.turns] == [
        [("text", "see <|image|> here: "), ("image", None), ("text", " and "), ("audio", None)], [("text", "a [TURN]"), ("attachment", None)], [("document", None), ("image", None)]]
    assert one.formatted.count("<|image|>") == 2 and one.learnt == "a [TURN]"
    assert [(t.role, t.text) for t in two.turns] == [("assistant", ""), ("user", "")] and two.n_tokens == 0 and two.attachments == []
    assert digests(done).where("conv_id = 2").first().n_turns == 2
