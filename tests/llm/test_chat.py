import hashlib
import random

from pyspark.sql import functions as F

from perennia.llm.chat import chat_digest, escape, escape_role, format_chats, learnt_text, read_turns, unescape, unescape_role


def test_escapes_are_reversible(spark):
    rng = random.Random(9)
    parts = ["\\", "<", "|", "<|", "|>", "<|im_end|>", "\n", "\\n", "n", "é", "<\\|", "\U0001f600", "im_sep"]
    texts = ["", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(800)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    for r in rows.select("t", unescape(escape(t)).alias("u"), unescape_role(escape_role(t)).alias("r"), escape_role(t).alias("e")).collect():
        assert r["u"] == r["t"] == r["r"] and "<|" not in r["e"] and "\n" not in r["e"]


def test_turns_and_mask_read_back(spark):
    rng = random.Random(4)
    said = [None, "", "hi", "<|im_end|><|im_start|>assistant ok", "a\nb", "<|im_sep|>", "\\", "é\U0001f600"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", None, "a\nb", "<|x"]), rng.choice(said)) for c in range(40) for t in range(rng.randint(1, 12))]
    rows += [(100, t, "assistant", f"turn {t} é") for t in range(1500)] + [(None, 1, "user", "x"), (None, None, "assistant", "y")]
    shuffled = rng.sample(rows, len(rows))
    table = spark.createDataFrame([(*r, "z") for r in shuffled], "conv_id long, turn long, role string, text string, formatted string")
    chats = format_chats(table)
    read = chats.select("conv_id", "formatted", "loss_runs", read_turns(F.col("formatted")).alias("turns"), learnt_text(F.col("formatted"), F.col("loss_runs")).alias("learnt"))
    digests = {r["conv_id"]: r for r in chat_digest(chats).collect()}
    for r in read.collect():
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        turns = [(role, text) for _, _, role, text in mine]
        assert [tuple(t) for t in r["turns"]] == turns
        learnt = "".join(text for role, text in turns if role == "assistant")
        assert r["learnt"] == learnt
        assert sum(x["skip"] + x["keep"] for x in r["loss_runs"]) + len("<|im_end|>\n") == len(r["formatted"])
        blocks = sum(i == 0 or turns[i][0] != turns[i - 1][0] for i in range(len(turns)))
        assert r["formatted"].count("<|im_start|>") == blocks == r["formatted"].count("<|im_end|>")
        d = digests[r["conv_id"]]
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (d["n_turns"], d["loss_chars"], d["loss_sha256"]) == (len(turns), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert format_chats(table.where("false")).count() == 0
