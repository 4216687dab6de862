from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from lodewatch.llm import chat_format, secret_scan, source_mix

CONTROL = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "<|", "|>", "\\", "<<||", "<|im_end|>\n", "%3C %0A", "\n\n", "😀<|é"]


def test_transcripts_read_back(spark):
    rows = [(1, i, random.Random(i).choice(["user", "assistant"]), t, "x") for i, t in enumerate(CONTROL)]
    rows += [(2, 0, "a\n%<|b", None, "x"), (2, 1, None, "no role", "x"), (2, 1, None, "no role", "x"), (2, None, "assistant", "no turn", "x"),
             (None, 0, "assistant", "long " * 30_000, "x"), (3, 0, "assistant", "", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    rendered = chat_format.render(chat_format.fold_events(chat_format.conversation_log(df)))
    got = {r["conv_id"]: r for r in rendered.select("conv_id", "formatted", "mask", chat_format.read_back(F.col("formatted")).alias("turns"), chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        turns = [(x[2] or "", x[3] or "") for x in own]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(turns)
    assert chat_format.render(chat_format.fold_events(chat_format.conversation_log(df.limit(0)))).count() == 0


def test_events_are_folded(spark):
    events = [
        (1, 1, 1, "message", "user", "hel"), (1, 2, 1, "delta", None, "lo"), (1, 3, 2, "message", "assistant", None),
        (1, 5, 2, "delta", None, "second "), (1, 4, 2, "delta", None, "first "), (1, 6, 3, "message", "user", "more"),
        (1, 7, 2, "regenerate", None, None), (1, 8, 2, "delta", None, "new"), (1, 9, 4, "message", "user", "after"),
        (1, 10, 1, "edit", None, "bye"), (1, 11, 1, "delta", None, "!"), (1, 12, 4, "unknown", None, "ignored"),
        (2, 1, 1, "delta", "assistant", "a"), (2, 1, 1, "delta", "assistant", "a"),
    ]
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")
    got = sorted(tuple(r) for r in chat_format.fold_events(df).collect())
    assert got == [(1, 1, "user", "bye!"), (1, 2, "assistant", "new"), (1, 4, "user", "after"), (2, 1, "assistant", "aa")]


BASE = [r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            if len(m[1] if kind == 0 else m[0]) >= (8, 16, 32)[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_secrets(spark):
    rng = random.Random(8)
    token = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    prose = "ordinary identifiers like determination_of_understanding and responsibility in everyday circumstances notwithstanding "
    texts = [None, "", "é😀 Password: 'hunter2hunter2' tail", "token=short secret: token:abcdefgh1 api_key = \"x.y-z/12345678\"", "AKIA" + "Z9" * 8 + " AKIASHORT AKIAAKIA" + "B" * 10,
             "f" * 31 + " " + "0a" * 16 + "g" + "0b" * 20, "secret=token=password=abcdefgh", "\n".join(f"token = \"{token(40, '0123456789abcdef')}\"" for _ in range(50)), prose * 200]
    planted = [f"{prose} {token(44, b64)} {prose}" for _ in range(20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + planted)] + [(1, "", "x"), (None, "AKIA" + "Z9" * 8, "x")], "doc_id long, text string, base string")
    rows = secret_scan.scan(df).collect()
    assert len(rows) == len(texts) + len(planted) + 2
    by_id = {r["id"]: r for r in rows}
    for i, t in enumerate(texts + planted):
        base = [(s["start"], s["kind"], s["end"]) for s in by_id[i]["base"]]
        assert base == plain_spans(t)
        every = [(s["start"], s["kind"], s["end"]) for s in by_id[i]["all"]]
        assert set(base) <= set(every) and every == sorted(every)
    hits = 0
    for i, t in enumerate(planted, len(texts)):
        hits += any(s["kind"] == 3 and t[s["start"] : s["end"]] == t.split()[len(prose.split())] for s in by_id[i]["all"])
    assert hits >= 18  # random strings of the usual length are found
    assert not [s for s in by_id[len(texts) - 1]["all"]]  # and prose is left alone
    assert secret_scan.scan(df.limit(0)).count() == 0


def plain_targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not above:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in above:
            target[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in above)
        free -= above
    return target


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "big" if i % 3 else rng.choice(["a", "b", "Z", "é", None]), "x") for i in range(3000)]
    rows += [(5000, None, "nothing", "x"), (5001, "", "nothing", "x"), (5002, "w " * 30_000, "one", "x"), (7, rows[7][1], rows[7][2], "x"), (None, "w w", "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    got = source_mix.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= (30 if s != "one" else 15_001)
    key = lambda r: repr((r["id"], r["source"], r["size"], r["taken"]))
    for options in ({}, {"bins": 3, "levels": 2}, {"bins": 7, "levels": 1}):  # neither a rerun nor the bins change the draw
        assert sorted(map(key, source_mix.mix(df, **options).collect())) == sorted(map(key, got))
    copies = source_mix.take_copies(df)
    assert copies.columns == df.columns
    assert copies.where("doc_id < 3000 and doc_id <> 7").count() == sum(r["copies"] for r in got if r["id"] is not None and r["id"] < 3000 and r["id"] != 7)
    assert source_mix.mix(df.limit(0)).count() == 0 and source_mix.take_copies(df.limit(0)).count() == 0


def test_copies_of_rows_without_or_with_the_same_id(spark):
    """Each row is taken as often as the mix says of it, whatever its id; sources stay near their targets."""
    words = " ".join(["word"] * 40)
    rows = [(None if i % 2 else i % 7, f"{words} {i}", f"s{i % 3}", i) for i in range(300 + 100)] + [(None, None, None, -1), (None, "", "s1", -2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row int")
    taken = source_mix.take_copies(docs)
    assert taken.columns == docs.columns
    got = {}
    for r in taken.collect():
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
    targets = {r["source"]: r["target"] for r in source_mix.mix(docs).collect()}
    assert set(got) == {"s0", "s1", "s2"} and all(abs(got[s] - targets[s]) <= 21 for s in got)
    assert max(taken.groupBy("row").count().toPandas()["count"]) <= 2
