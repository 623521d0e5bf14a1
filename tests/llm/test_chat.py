import hashlib
import random

from pyspark.sql import functions as F

from tidewell.llm.chat import chat_report, format_chats, read_back, text_part

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return chat_report(df.select("*", text_part(F.col("text")).alias("parts"))).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_random_texts_come_back(spark):
    rng = random.Random(3)
    bits = ["<|turn|>", "<|end|>", "<|body|>", "&", "&lt;", "&amp;lt;", "[INST]", "</s>", "é", "日", "\n", "", "x", "<", "[", "\\", "\U0001f600"]
    rows = [(c, t, rng.choice(["user", "assistant", "a&<b"]), "".join(rng.choices(bits, k=rng.randint(0, 30)))) for c in range(30) for t in range(rng.randint(1, 6))]
    got = {r.conv_id: r for r in run(spark, rows)}
    for c in range(30):
        mine = [r for r in rows if r[0] == c]
        learned = "".join(t for _, _, role, t in mine if role == "assistant")
        r = got[c]
        assert r.n_turns == len(mine) and r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, _, role, t in mine))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))


def test_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, None, "first"), (None, 1, "assistant", "z"), (2, 5, "assistant", "word " * 200_000)]
    got = {r.conv_id: r for r in run(spark, rows)}
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha("\nfirst\nuser\n\nuser\nb\nuser\nb\n") and got[1].loss_chars == 0
    assert got[None].loss_chars == 1 and got[2].loss_chars == 1_000_000


def test_equal_turns_are_ordered_by_their_texts(spark):
    r = run(spark, [(1, 0, "assistant", "<x"), (1, 0, "assistant", "5"), (1, 0, "assistant", "[")])[0]
    assert r.turns_sha256 == sha("assistant\n5\nassistant\n<x\nassistant\n[\n") and r.loss_sha256 == sha("5<x[")


def test_empty(spark):
    assert run(spark, [(1, 0, "user", "x")]) and chat_report(spark.createDataFrame([], SCHEMA).withColumn("parts", text_part(F.col("text")))).collect() == []


def test_typed_parts(spark):
    part = "struct<kind:string,text:string,ref:string,tokens:int>"
    rows = [(1, 0, "user", [("text", "see <", None, None), ("image", None, "a.png", 3), ("document", None, "b.pdf", 2), ("odd", None, "c", None)]), (1, 1, "assistant", [("audio", None, "c.wav", 1), ("text", "ok", None, None)]), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    r = read_back(format_chats(df)).first()
    assert r.formatted == "<|turn|>user<|body|>see &lt;" + "<|image|>" * 3 + "<|document|>" * 2 + "<|end|><|turn|>assistant<|body|><|audio|>ok<|end|><|turn|>user<|body|><|end|>"
    assert [tuple(a) for a in r.attachments] == [(0, 1, "image", "a.png", 3), (0, 2, "document", "b.pdf", 2), (0, 3, "odd", "c", 0), (1, 0, "audio", "c.wav", 1)]
    assert [r.formatted[m.start : m.start + m.length] for m in r.loss_mask] == ["<|audio|>ok"]
    assert [t.role for t in r.read] == ["user", "assistant", "user"]
