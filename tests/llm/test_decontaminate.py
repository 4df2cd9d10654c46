from __future__ import annotations

import random
from collections import Counter

import regex

from shelfcast.llm import decontaminate

ITEM = "A farmer called Tom has 12 apples and sells 5 apples to Anna. How many apples does Tom have if Anna gives 5 back?"
OTHER = "Which planet in the solar system has the largest number of known moons around it today?"


def found(spark, docs, items=((1, ITEM), (2, OTHER))):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.changed for r in decontaminate.leaks(docs, bench).collect()}


def test_copies_and_changed_parameters(spark):
    changed = ITEM.replace("Tom", "Ben").replace("12", "340").replace("5", "7").replace("Anna", "Maria")
    torn = changed.replace("gives 7", "gives 9").replace("to Maria", "to Lucy")
    docs = [
        (10, "Some words before. " + ITEM + " And some words after it."),
        (11, "Here is a task: " + changed),
        (12, torn),  # one value became two: another question
        (13, ITEM[: len(ITEM) // 3]),
        (14, "An unrelated text about Tom and 12 apples that nobody sells to anyone at all in this town."),
        (15, OTHER.upper().replace(" ", "\n")),
        (16, None),
        (17, ""),
        (18, ITEM + "\n" + OTHER),
    ]
    got = found(spark, docs)
    assert set(got) == {(10, 1), (11, 1), (15, 2), (18, 1), (18, 2)}
    assert got[10, 1] == 0 and got[11, 1] == 4 and got[18, 2] == 0


def test_one_slot_that_breaks_costs_its_windows_only(spark):
    three = "Take 4 eggs from the box on the table, put 4 cups on the tray beside it and then wash all the 4 spoons in the sink"
    docs = [
        (1, ITEM.replace("gives 5", "gives 6")),  # one of two numbers
        (2, ITEM.replace("does Tom", "does Tim")),  # a misspelt name
        (3, ITEM.replace("12", "90").replace("gives 5", "gives 6")),
        (4, three.replace("4", "9").replace("9 spoons", "8 spoons")),  # two against one
        (5, three.replace("4 eggs", "7 eggs").replace("4 cups", "8 cups").replace("4 spoons", "9 spoons")),  # all differ
        (6, "Each of 3 boys has 5 of the 7 nets"),
    ]
    items = [(1, ITEM), (2, three), (3, "Each of 3 boys has 3 of the 3 nets")]
    assert found(spark, docs, items) == {(1, 1): 1, (2, 1): 1, (3, 1): 2, (4, 2): 1}


def test_units_and_signs(spark):
    item = "The road is 12 km long and the bus needs 30 minutes for it, how fast does the bus drive on average"
    good = "The road is 900 miles long and the bus needs 7.5 hours for it, how fast does the bus drive on average"
    assert found(spark, [(1, good), (2, good.replace("bus", "train"))], [(5, item)]) == {(1, 5): 4}


def test_short_items_and_nulls(spark):
    items = [(1, "two words"), (2, None), (3, ""), (None, OTHER), (4, OTHER)]
    docs = [(1, "Two words."), (2, "two words more"), (None, OTHER), (3, OTHER), (3, OTHER)]
    assert found(spark, docs, items) == {(1, 1): 0, (None, None): 0, (None, 4): 0, (3, None): 0, (3, 4): 0}


def test_short_items_inside_longer_documents(spark):
    items = [(1, "What is the capital of France?"), (2, "Name 3 rivers."), (3, "1789"), (4, "two words"), (5, OTHER)]
    filler = "a text of its own that goes on for more than a window of tokens"
    docs = [
        (1, f"{filler}. What is the capital of France? {filler}"),
        (2, f"{filler}, question: What is the capital of Spain, {filler}"),  # inside a sentence, another name
        (3, f"{filler}. Paris is the capital of France, {filler}"),
        (4, f"{filler}: Name 12 rivers and two words more"),
        (5, f"{filler} in 1789 and 1848"),
        (6, f"{filler} in 1790, two other words"),
        (7, f"{filler} {OTHER}"),
        (8, None),
    ]
    want = {(1, 1): 0, (2, 1): 1, (4, 2): 1, (4, 4): 0, (5, 3): 0, (7, 5): 0}
    assert found(spark, docs, items) == want
    assert found(spark, docs, items[:4]) == {k: v for k, v in want.items() if k[1] < 5}


def test_dropping_keeps_the_rest(spark):
    rows = [(1, "clean text of its own", "a"), (2, ITEM, "b"), (None, ITEM, "c"), (None, "other", "d"), (3, None, "e"), (4, "", "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id string").selectExpr("*", "item_id AS hash", "1 AS windows")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    out = decontaminate.drop_leaks(frame, bench)
    assert out.dtypes == frame.dtypes
    assert sorted(r.item_id for r in out.collect()) == ["a", "d", "e", "f"]
    assert decontaminate.drop_leaks(frame, bench.where("false")).count() == 6
    assert decontaminate.drop_leaks(frame.where("false"), bench).collect() == []


def test_long_text_with_the_item_inside(spark):
    filler = " ".join(f"word{i % 977}x" for i in range(60_000))
    assert set(found(spark, [(1, f"{filler}. {ITEM} {filler}"), (2, filler)])) == {(1, 1)}


def test_planted_passages_of_the_test_data(spark):
    """Whole benchmark texts inside documents, found by plain search, are all found; nothing else is."""
    import re

    folder = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in plain(r.text)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert want and got == want


def typed(text):
    """(value, slot) of every token, by plain loops."""
    raw = regex.findall(r"[0-9]+(?:[.,][0-9]+)*|\p{L}[\p{L}\p{M}]*|[%$€£]|[.!?\n]", text or "")
    out = []
    for before, token in zip(["\n", *raw], raw):
        first = token[0]
        if first.isdigit():
            slot = "<number>"
        elif token in decontaminate.SIGNS or (before[0].isdigit() and token.lower() in decontaminate.UNITS):
            slot = "<unit>"
        elif before not in decontaminate.ENDS and first.lower() != first and token.upper() != token:
            slot = "<name>"
        else:
            slot = None
        if token not in decontaminate.ENDS:
            out.append((token.lower(), slot))
    return out


def windows_of(tokens, length, whole):
    """Keys of the windows; ``whole`` is the usual length, below which the first token stands as in a text's start."""
    out = []
    for i in range(len(tokens) - length + 1):
        part = tokens[i : i + length]
        shown = [slot or value for value, slot in part]
        if length < whole:
            value, slot = part[0]
            shown[0] = slot if slot and (slot == "<number>" or value in decontaminate.SIGNS) else value
        out.append(tuple(shown) if any(not t.startswith("<") for t in shown) else ("values", *(v for v, _ in part)))
    return out


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        for item_id, item_text in items:
            here, there = typed(text), typed(item_text)
            if not there:
                continue
            whole = decontaminate.WINDOW
            length = min(len(there), whole)
            if len(here) < whole and len(here) != length:
                continue
            mine, theirs = windows_of(here, length, whole), windows_of(there, length, whole)
            need = decontaminate.SHARE * len(set(theirs))
            if len(set(mine) & set(theirs)) < need:
                continue
            times = Counter(theirs)
            lines = {pos: pos - theirs.index(key) for pos, key in enumerate(mine) if times[key] == 1}
            close = []
            for pos, key in enumerate(mine):
                if key not in times:
                    continue
                before = [lines[p] for p in sorted(lines) if p <= pos][-1:]
                after = [lines[p] for p in sorted(lines) if p >= pos][:1]
                for line in [*before, *after, pos - theirs.index(key)]:
                    if 0 <= pos - line < len(theirs) and theirs[pos - line] == key:
                        close.append((pos, key, line))
                        break
            kept, pairs = [], {}
            for line in {c[2] for c in close}:
                own = [c for c in close if c[2] == line]
                at = {pos - line + i for pos, _, _ in own for i in range(whole)}
                slots = [
                    (i, there[i][0], here[line + i][0])
                    for i in sorted(at)
                    if i < len(there) and 0 <= line + i < len(here) and there[i][1] and here[line + i][1]
                ]
                torn = set()
                for old in {s[1] for s in slots}:
                    counts = Counter(s[2] for s in slots if s[1] == old)
                    if len(counts) > 1:
                        most = max(counts.values())
                        top = [v for v, n in counts.items() if n == most]
                        taken = old if old in top else top[0] if len(top) == 1 else None
                        torn |= {s[0] for s in slots if s[1] == old and s[2] != taken}
                left = [c for c in own if not any(c[0] - line <= t < c[0] - line + whole for t in torn)]
                kept += left
                if left:
                    pairs.setdefault("changed", set()).update(s[1] for s in slots if s[1] != s[2])
            if kept and len({k for _, k, _ in kept}) >= need:
                found[doc_id, item_id] = len(pairs["changed"])
    return found


def test_equals_brute_force_on_random_texts(spark):
    rng = random.Random(11)
    words = ["the", "box", "Tom", "Anna", "has", "3", "5", "7", "km", "%", "12", "of", "and"]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", "."]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 5, 8, 9, 14, 25, 40]))) for i in range(25)]
    items += [(25, "3 5 7 9 11 13 15 17 19 21 23"), (26, "box " * 30), (27, "Tom has 3 of the 5 km " * 5)]
    docs = []
    for i in range(120):
        parts = [text(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            copied = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                copied[rng.randrange(len(copied))] = rng.choice(words)
            parts += [" ".join(copied) * rng.choice([1, 1, 3]), text(rng.randint(0, 10))]
        docs.append((i, " ".join(parts)))
    docs += [(200, "box " * 400), (201, ("box " * 9 + "Tom ") * 40), (202, "3 5 7 9 11 13 15 17 19 21 23 25"), (203, "Tom has 4 of the 6 km " * 30)]
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    assert len(want) > 30


def test_windows_of_slots_alone_go_by_their_values(spark):
    items = [(1, "3 5 7 9 11 13 15 17 19 21 23")]
    hours = "Opening hours and prices: " + " ".join(str(n) for n in range(10, 130, 10))
    assert found(spark, [(1, hours), (2, "Primes or not: 3 5 7 9 11 13 15 17 19 21 23 and so on")], items) == {(2, 1): 0}


def test_repeated_windows_give_rows_in_proportion(spark, monkeypatch):
    counted = {}
    plain = decontaminate.stage

    def counting(frame, label):
        out = plain(frame, label)
        counted[label] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "stage", counting)
    items = [(i, " ".join(str(n % 3) for n in range(60))) for i in range(20)] + [(30, "box " * 50)]
    docs = [(1, " ".join(str(n % 3) for n in range(400))), (2, "box " * 500)]
    got = found(spark, docs, items)
    assert set(got) == {*((1, i) for i in range(20)), (2, 30)}
    assert counted["leak-close"] <= 20 * 400 + 500


def test_a_million_digits_and_separators(spark):
    texts = ["1." * 500_000 + "1", "1," * 500_000, "1,.," * 250_000, "7 " * 200_000]
    short = [(3, "two more words"), (4, "1234567 7")]
    assert found(spark, [(i, text + " " + ITEM) for i, text in enumerate(texts)], [(1, ITEM), *short]) == {(i, 1): 0 for i in range(4)}
