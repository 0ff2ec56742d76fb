from pyspark.sql import functions as F

from demandloom.llm import chat

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"
TRICKY = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>[\\INST]", "a < b [c] \\ \\\\", "", "[INST", "<<s>>", "🤗</s>\n",
          "<" + "\\" * 50 + "s>"]


def turns(spark, events):
    made = chat.render(chat.fold_events(spark.createDataFrame(events, LOG)))
    made = made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                       chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    return {r["conv_id"]: r for r in made.collect()}


def test_control_strings_come_back_unchanged(spark):
    events = [(1, i, i, "message", "assistant" if i % 2 else "us</s>er", t) for i, t in enumerate(TRICKY * 2)]
    row = turns(spark, events)[1]
    assert [tuple(t) for t in row["turns"]] == [(e[4], e[5]) for e in events]
    assert row["learned"] == "".join(e[5] for e in events if e[4] == "assistant")
    assert row["formatted"].count("</s>") == row["formatted"].count("[INST]") == len(events)


def test_folds_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 1, "message", "assistant", "Hel"), (1, 2, 1, "delta", None, "lo"), (1, 3, 1, "delta", None, " you"),
        (1, 4, 2, "message", "user", "old question"), (1, 5, 3, "message", "assistant", "old answer"),
        (1, 6, 2, "edit", "user", "new question"), (1, 7, 3, "message", "assistant", "new"),
        (1, 8, 3, "regenerate", None, None), (1, 9, 3, "delta", None, "better"),
        (2, 5, 0, "delta", "assistant", "no opening"), (2, 4, 0, "delta", "assistant", "late: "),
        (None, 0, 0, "message", None, None),
    ]
    made = turns(spark, log[::-1])
    assert [tuple(t) for t in made[1]["turns"]] == [
        ("user", "hi"), ("assistant", "Hello you"), ("user", "new question"), ("assistant", "better")]
    assert made[1]["learned"] == "Hello youbetter"
    assert [tuple(t) for t in made[2]["turns"]] == [("assistant", "late: no opening")]
    assert [tuple(t) for t in made[None]["turns"]] == [("", "")]


def test_ties_repeated_rows_and_long_streams(spark):
    events = [(1, 0, 0, "message", "user", t) for t in ("b", "a", "a")]
    events += [(2, 0, 0, "message", "assistant", "")] + [(2, i + 1, 0, "delta", "assistant", f"{i},") for i in range(3000)]
    made = turns(spark, events)
    assert [t["text"] for t in made[1]["turns"]] == ["a", "a", "b"]
    assert made[2]["learned"] == "".join(f"{i}," for i in range(3000))


def test_empty_log_and_unknown_kinds(spark):
    import pytest

    assert turns(spark, [])  == {}
    with pytest.raises(Exception, match="unknown kind"):
        turns(spark, [(1, 0, 0, "other", "user", "x")])


def test_streamed_logs_fold_back_to_their_rows(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} {t} " + TRICKY[(c + t) % len(TRICKY)] * (t * 9)) for c in range(12)
            for t in range(6)]
    rows += [(20, 0, "assistant", "b"), (20, 0, "assistant", "a"), (20, 0, "assistant", "a"), (20, None, "assistant", "first"),
             (20, -3, "user", None), (20, 1, None, "x"), (None, 1, "assistant", "n" * 1000), (None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "1 seq", "2 kind", "3 e", "4 first")
    log = chat.streamed_events(table, delta_chars=7)
    kinds = {r["kind"]: r["n"] for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["delta"] > 100 and kinds["edit"] > 5 and kinds["regenerate"] > 5
    names = ("conv_id", "turn", "role", "text")
    made = [tuple(r[n] for n in names) for r in chat.fold_events(log).collect()]
    plain = [tuple(r[n] for n in names) for r in chat.fold_events(chat.events_of_turns(table)).collect()]
    assert sorted(made, key=repr) == sorted(plain, key=repr)
    assert sorted(made, key=repr) == sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=repr)
    a, b = (chat.render(chat.fold_events(e)).orderBy("conv_id").collect() for e in (log, chat.events_of_turns(table)))
    assert a == b
    assert chat.fold_events(chat.streamed_events(table.limit(0))).collect() == []
