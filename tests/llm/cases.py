"""Documents with everything an operator has to bear, and plain Python versions of what they must give."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Columns that operators use as names of their own.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, size int, row string, copy int, kind int, hash string"


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def make_documents(seed: int = 5, n: int = 90) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijkléöñ") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(80)]
    line = "Shared Line number one, all rights reserved"
    texts: list[str | None] = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 160))]
        if i % 4 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage[rng.randint(0, 20) :]
        if i % 5 == 1 and texts and texts[-1]:
            words = texts[-1].split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = " ".join(words).capitalize()
        for _ in range(rng.randint(0, 4)):
            spaces = [m.start() for m in re.finditer(" ", text)]
            if spaces:
                at = rng.choice(spaces)
                text = text[:at] + rng.choice(["\n", "\n\n", "\t", f"\n {line.upper()} \n", "\r\n"]) + text[at + 1 :]
        texts.append(text)
    texts += [None, "", " \n\t", "one", "One", "a b c", "A  b\nc", line, line + "\n" + line, texts[3], texts[3] + " "]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(20_000)) + " " + " ".join(passage))
    rows = []
    for i, text in enumerate(texts):
        source = [None, "s1", "s2", "src0", "a.example.org"][rng.randrange(5)]
        rows.append((i * 3, text, rng.choice(["en", "de", None]), source, 0, "x", "y", 1, "z", 7, 0, "h"))
    # Repeated rows, a null id, and large ids.
    rows += [rows[4], rows[9], rows[9], (None, texts[8], "en", "s1", 0, "x", "y", 1, "z", 7, 0, "h")]
    rows.append((10**15, texts[8], None, None, None, None, None, None, None, None, None, None))
    rng.shuffle(rows)
    return rows


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def order(doc_id):
    return float("inf") if doc_id is None else doc_id


def substrings(rows, window=50):
    words = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    first = {}
    for doc, w in words:
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, float("inf")), order(doc))
    out = []
    for doc, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(doc):
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def lines(rows):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    first = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), float("inf")), order(r[0]))
    out = []
    for r in rows:
        own = (r[1] or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or first[key(x)] >= order(r[0])]
        out.append((r[0], len(own), len(own) - len(kept), sha("\n".join(kept))))
    return out


def exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = []
    for bare, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), order(r[0])))
        out += [(r[0], best[0], len(members), sha(bare)) for r in members]
    return out


def contamination(rows, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])].add(str(item) if item is not None else "null")
    sizes = {len(w) for w in windows}
    out = []
    for r in rows:
        w = ALNUM.findall(lower(r[1] or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                owners = windows.get(tuple(w[i : i + size]))
                if owners:
                    found |= owners
                    hit.update(range(i, i + size))
        out.append((r[0], len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def jaccard(rows, size=4, percent=85):
    sets = []
    for r in rows:
        w = WORD.findall(lower(r[1] or ""))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), float("inf")), order(r[0]))
    return [(r[0], len(sets[i]), least[find(i)] if least[find(i)] != float("inf") else None) for i, r in enumerate(rows)]
