"""Conversation repair, fill-in-middle and the quality classifier against plain versions on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tideline.llm import conversations, glr, infilling, quality

ROWS = cases.make_documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, cases.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], cases.SCHEMA)


# Conversation repair

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"


def with_inserts(best):
    best, changed = dict(best), True
    while changed:
        changed = False
        for state, (cost, audit, lines) in list(best.items()):
            for s in "ua":
                to = NEXT.get((state, s))
                way = (cost + 3, audit + "I", [*lines, f"{NAMES[s]}:"])
                if to is not None and (to not in best or way < best[to]):
                    best[to], changed = way, True
    return best


def cheapest(rows):
    """(cost, audit, lines) for rows of (role, text, fault), by trying every edit at every state."""
    best = {0: (0, "", [])}
    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            ways = [(state, (cost + 4, audit + "D", lines))]
            if fault in (None, "truncated"):
                extra = 3 if fault else 0
                ways.append((NEXT.get((state, role[:1])), (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                for s in "ua":
                    ways.append((NEXT.get((state, s)), (cost + 3 + extra, audit + "R", [*lines, f"{NAMES[s]}:{text}"])))
            for to, way in ways:
                if to is not None and (to not in found or way < found[to]):
                    found[to] = way
        best = found
    best = with_inserts(best)
    return min(best[state] for state in (0, 3) if state in best)


def plain_repair(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, judged, count = set(), [], Counter()
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] += 1
            judged.append((role, text, fault))
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, cases.sha("\n".join(lines)))
    return out


def talks(seed, n_conv, most):
    rng, rows = random.Random(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "", None, "User", "ape", "tool"]
    texts = ["Yes.", "No", " \t", "", None, "Is it?\n ", "é!", "Well, ü", "Yes. ", "\x00."]
    for conv in [*range(n_conv), None]:
        turn = 0
        for _ in range(rng.randint(1, most)):
            turn += rng.choice([0, 1, 1, 1, 2])
            text = rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}{rng.choice('.!?x')}"
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv, rng.choice([turn, turn, turn, turn, None]), role, text))
            if rng.random() < 0.1:
                rows += [rows[-1]] * rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


SUMMARY = [*conversations.SUMMARY, "audit"]


@pytest.mark.parametrize("unit_rows, most", [(4096, 12), (3, 12), (1, 30)])
def test_repair(spark, unit_rows, most):
    rows = talks(unit_rows, 60, most)
    frame = spark.createDataFrame(
        [(*r, 1, "x", b"y", 2, "z", 0) for r in rows],
        "conv_id long, turn long, role string, text string, kind int, piece string, digest binary, number int, conv string, n int",
    ).repartition(7)
    found = conversations.repair(frame, unit_rows=unit_rows)
    want = plain_repair(rows)
    got = {r["conv"]: tuple(r[c] for c in SUMMARY) for r in found.conversations.collect()}
    assert got == {conv: x[:-1] for conv, x in want.items()}
    hashes = {r["conv"]: r["sha256"] for r in conversations.text_hashes(found.messages).collect()}
    assert all(hashes.get(conv, cases.sha("")) == x[-1] for conv, x in want.items())
    messages = found.messages.orderBy("conv", "number").collect()
    assert Counter(m["conv"] for m in messages) == Counter({c: len(x[6].replace("D", "")) for c, x in want.items()})
    for m in messages:
        assert m["edit"] in "KRI" and (m["edit"] != "I" or m["text"] == "")


def test_one_conversation_over_many_tasks(spark):
    """A conversation with all rows, a third of them one row, and units that tie."""
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i}{rng.choice('..x')}") for i in range(3000)]
    rows += [(7, None, "user", "Same.")] * 1500
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    found = conversations.repair(frame, unit_rows=50)
    assert found.messages.rdd.getNumPartitions() > 1
    row = found.conversations.first()
    # The plain version compares whole audits, so this one only adds up costs.
    want = plain_repair(rows)[7]
    assert tuple(row[c] for c in SUMMARY) == want[:-1]
    assert conversations.text_hashes(found.messages).first()["sha256"] == want[-1]


def test_damage_and_summary(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"Text {c}. It is {t}!") for c in range(80) for t in range(4)]
    rows += [(None, None, None, None), (900, None, "user", "Hm."), (901, 2, "system", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        damaged += [(conv, turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    got = Counter(tuple(r) for r in conversations.damaged(frame).collect())
    assert got == Counter(damaged)
    want = dict.fromkeys((r[0] for r in rows), (0, 0, 0, 0, 0, 0, "", cases.sha(""))) | plain_repair(damaged)
    out = conversations.repaired_summary(frame, conversations.damaged(frame)).collect()
    assert len(out) == len(want)
    assert {r["conv_id"]: (*(r[c] for c in SUMMARY), r["repaired_sha256"]) for r in out} == want
    nothing = frame.where("false")
    assert conversations.repaired_summary(nothing, conversations.damaged(nothing)).count() == 0
    assert conversations.repaired_summary(frame, nothing).where(f"audit = '' AND repaired_sha256 = '{cases.sha('')}'").count() == len(want)


def test_parser_on_any_grammar():
    """Bracketed lists, whose stacks two ways of reducing reach; repaired words are in the language."""
    rules = [("list", ("item",)), ("list", ("list", "item")), ("item", ("x",)), ("item", ("o", "x", "c"))]
    repair = glr.Repairer(glr.Automaton(rules), ("x", "c"), glr.Costs(delete=2, rerole=5, insert=3))
    rng = random.Random(8)
    language = re.compile(r"(x|oxc)+\Z")
    for _ in range(200):
        word = [rng.choice("xoc?") for _ in range(rng.randint(0, 9))]
        rows = [(glr.Row(c), 1) for c in word]
        ways = []
        for stack, cost, edits in repair.paths(rows):
            ways += [(cost + 3 * n, glr.audit_of("".join(edits)) + "I" * n, [*edits, last]) for n, last in repair._ends[stack]]
        cost, audit, edits = min(ways)
        spelled = "".join(
            "".join(re.sub("D", "", piece.replace("K", c))) if i < len(word) else piece
            for i, (piece, c) in enumerate(zip(edits, [*word, ""]))
        )
        assert language.match(re.sub("[RI]", "", spelled))
        assert cost == 2 * audit.count("D") + 5 * audit.count("R") + 3 * audit.count("I")
        if language.match("".join(word)):
            assert (cost, audit) == (0, "K" * len(word))
    with pytest.raises(ValueError, match="left-recursively"):
        glr.Automaton([("deep", ()), ("deep", ("o", "deep", "c"))], most_stacks=50)


def test_steps_stay_few():
    repair = conversations.repairer(glr.Costs())
    rng = random.Random(2)
    repair.paths([(glr.Row(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.2), 1) for _ in range(50_000)])
    assert len(repair._steps) < 3000
    repair.paths([(glr.Row("x", True), 1)] * 50_000)
    assert len(repair._steps) < 3100


# Fill-in-middle


def plain_infilling(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in infilling.MARKS) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


INFILLED = ["n", "form", "prefix_chars", "middle_chars", "output"]


@pytest.mark.parametrize("part_bytes", [64, infilling.PART_BYTES])
def test_fill_in_middle(docs, none, part_bytes):
    made = infilling.fill_in_middle(docs, part_bytes=part_bytes, keep_row=True)
    out = made.withColumn("back", infilling.restored(F.col("output"), F.col("form"))).collect()
    got = Counter((r["id"], r["row"]["text"], *(r[c] for c in INFILLED)) for r in out)
    assert got == Counter((r[0], r[1], *plain_infilling(r[0], r[1])) for r in ROWS)
    assert all(r["back"] == (r["row"]["text"] or "") for r in out)
    assert infilling.fill_in_middle(none).count() == 0


def test_any_text_and_part():
    rng = random.Random(1)
    atoms = ["a", "Bc", "é", "ß ", " ", "\n", "\x00", "😀", "<", "P>", "<S", "1", "word"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["", "x" * 9000, "😀" * 300, "a<M>b", "é" + "y" * 5000 + "é"]
    draws = [[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for i in range(len(texts))] for k in range(4)]
    for limit in (1, 3, 10, 50, 1 << 20):
        columns = infilling.transformed(
            pa.array(texts, pa.large_string()), [np.array(x) for x in draws], 90, 20, infilling.MARKS, limit
        )
        assert list(zip(*[c.to_pylist() for c in columns])) == [plain_infilling(i, t) for i, t in enumerate(texts)]


def test_marks_and_shares(spark):
    rows = spark.createDataFrame([(i, "ab cd, ef <S> gh " * 3) for i in range(400)], "doc_id long, text string")
    made = infilling.fill_in_middle(rows, seed=5, plain_percent=0, spm_percent=50, marks=("[p]", "[s]", "[m]"))
    back = infilling.restored(F.col("output"), F.col("form"), ("[p]", "[s]", "[m]"))
    assert made.where(back == "ab cd, ef <S> gh " * 3).count() == 400
    forms = Counter(r["form"] for r in made.collect())
    assert forms["plain"] == 0 and 140 < forms["spm"] < 260
    assert made.select("prefix_chars", "middle_chars").distinct().count() > 100


# Quality


def labelled(n=1200, seed=9):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(rng.randint(5, 300)))
        if not good:
            text = rng.choice([text.upper() + "!!!", re.sub(" ", " ## ", text), " ".join(text.split()[:3] * 40), re.sub("[aeiou]", "9", text)])
        docs.append((i, text))
        if rng.random() < 0.7:
            labels.append((i, int(good)))
    return docs, labels, {i: int(t) for i, t in labels}


def test_quality_on_held_out_rows(spark):
    docs, labels, truth = labelled()
    extra = [(None, None), (5000, ""), (5001, " \n"), (5002, "One."), docs[3], docs[3], (5003, docs[3][1])]
    frame = spark.createDataFrame([*docs, *extra], "doc_id long, text string").selectExpr("*", "7 AS x", "'q' AS label").repartition(5)
    noisy = [*labels, *labels[:50], (3, None), (4, 9), (None, 1)]
    out = quality.score_quality(frame, spark.createDataFrame(noisy, "doc_id long, quality int").selectExpr("*", "1 AS id")).collect()
    assert len(out) == len(docs) + len(extra)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str("" if r["id"] is None else r["id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(r["predicted"], truth[r["id"]]) for r in out if r["held_out"] and r["id"] in truth]
    assert len(held) > 200 and sum(p == t for p, t in held) >= 0.97 * len(held)
    assert len({r["score"] for r in out if r["id"] in (3, 5003)}) == 1
    # Labels of held-out rows change nothing.
    other = [(i, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, t) for i, t in noisy if t in (0, 1) and i is not None]
    again = quality.score_quality(frame, spark.createDataFrame(other, "doc_id long, quality int")).collect()
    assert all(math.isclose(a["score"], b["score"], rel_tol=1e-6, abs_tol=1e-9)
               for a, b in zip(sorted(out, key=str), sorted(again, key=str)))


def test_quality_without_labels(spark, docs, none):
    labels = spark.createDataFrame([(i, 1) for i in range(0, 90, 3)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_quality(docs, labels).collect()} == {1.0}
    assert {r["score"] for r in quality.score_quality(docs, labels.where("false")).collect()} == {0.5}
    assert quality.score_quality(none, labels).count() == 0


def test_discriminant_is_the_density_difference():
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + k for k in (0, 1)]
    n, sums = np.array([400.0, 400.0]), np.array([a.sum(0) for a in x])
    products = np.array([a.T @ a for a in x])
    model = quality.Discriminant.fit(n, sums, products, strength=0, ridge=0)
    logs = []
    for k, a in enumerate(x):
        cov = np.cov(a.T, bias=True) + 1e-6 * np.eye(3)
        z = x[0] - a.mean(0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.scores(x[0]), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_statistics_do_not_depend_on_the_block():
    texts = [(r[1] or "").encode() for r in ROWS[:60]]
    alone = np.vstack([quality.statistics([t]) for t in texts])
    assert np.allclose(quality.statistics(texts), alone) and np.isfinite(alone).all()
    assert quality.statistics([]).shape == (0, len(quality.NAMES))
