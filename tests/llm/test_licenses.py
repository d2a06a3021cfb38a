import random
import re

from helpers import LONG, ROWS, awkward
from paralane.llm.licenses import DENIALS, PHRASES, TEMPLATES, scan_licenses


def brute(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        key = phrase.split()
        for k in range(len(words) - len(key) + 1):
            if words[k : k + len(key)] == key:
                starts.append(k)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def run(spark, rows):
    return scan_licenses(awkward(spark, rows)).collect()


def check(spark, rows):
    found = run(spark, rows)
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    for r in found:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
        assert (r["score"] == 1.0) or r["base_labels"] == ""
    return {r["doc_id"]: r for r in found}


def test_phrases_in_awkward_rows(spark):
    extra = [
        (50, "Under the MIT License, under_the-mit/license."), (51, "UNDER THE MIT"), (52, "cc by cc by nc by nc cc-BY-nc"),
        (53, "apache license version 2apache license version 2"), (54, "the mit license under the mit"), (55, "under the mit\x7flicense"),
        (56, "under the mit Kicense İcc by nc"), (57, "éunder the mit license"), (58, LONG + " Apache License, Version 2 " + LONG), (59, "mit " * 500),
    ]
    check(spark, ROWS + extra)


def test_random_words(spark):
    random.seed(3)
    words = sorted({w for p in PHRASES for w in p.split()} | {"x"})
    check(spark, [(i, " ".join(random.choice(words) for _ in range(random.randint(0, 60)))) for i in range(300)])


def test_templates_add_labels(spark):
    rows = []
    for i, t in enumerate(TEMPLATES):
        rows.append((i, f"Copyright 2024 somebody. {t.text.upper()}. more text"))
        words = t.words
        far = [k for k in range(len(words)) if not t.key_at <= k < t.key_at + len(t.key.split())]
        words[far[-1]] = "changed"
        rows.append((100 + i, "intro " + " ".join(words)))
        broken = t.words
        broken[t.key_at + 1] = "broken"
        rows.append((200 + i, " ".join(broken)))
        rows.append((300 + i, " ".join(sorted(t.words))))
    found = check(spark, rows)
    for i, t in enumerate(TEMPLATES):
        assert t.label in found[i]["labels"].split(",") and found[i]["score"] == 1.0
        assert t.label in found[100 + i]["labels"].split(",")
        assert t.label not in found[200 + i]["labels"].split(",") or t.label in found[200 + i]["base_labels"].split(",")
        assert found[300 + i]["labels"] == "" and found[300 + i]["score"] == 0.0


def test_short_notices(spark):
    line = "This work is licensed under the GNU General Public License, version 3."  # of the given tables
    notices = {
        line: "gpl", "Licensed under the GNU GPL version 2": "gpl", "GNU General Public License": "gpl",
        "License: BSD-3-Clause": "bsd", "MIT License": "mit", "Apache License 2.0": "apache-2", "under the ISC license": "isc",
        "Mozilla Public License, Version 2.0": "mpl-2", "Creative Commons Attribution-NonCommercial 4.0": "cc-by-nc",
        "Mozilla Public License, Version 1.1": "", "GNU public general license": "", "All rights reserved.": "",
    }
    found = check(spark, [*enumerate(notices), (50, f"{LONG}\n{line}\n{LONG}"), (51, line.replace("3", "two"))])
    assert [found[i]["labels"] for i in range(len(notices))] == list(notices.values())
    assert [(found[i]["labels"], found[i]["score"]) for i in (0, 50, 51)] == [("gpl", 1.0)] * 3


def test_a_key_phrase_is_found_whatever_words_other_documents_have(spark):
    gpl = next(t for t in TEMPLATES if t.label == "gpl")
    rarest = ("and", "as", "by")  # at equal frequencies the first of the alphabet
    text = " ".join("changed" if word in rarest else word for word in gpl.words)
    assert [(r["labels"], r["score"]) for r in scan_licenses(awkward(spark, [(1, text)]), templates=[gpl]).collect()] == [("gpl", 21 / 24)]


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(awkward(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_rows(spark):
    assert run(spark, []) == []


def brute_template(text, templates):
    """labels and score of the templates, by trying every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    labels, best = set(), 0.0
    for t in templates:
        key = t.key.split()
        for k in range(len(words) - len(key) + 1):
            if words[k : k + len(key)] != key or set(words[max(0, k - 4) : k]) & set(DENIALS):
                continue
            start = k - t.key_at
            same = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(t.words))
            if same / len(t.words) >= t.least:
                labels.add(t.label)
                best = max(best, same / len(t.words))
    return labels, best


def test_labels_and_scores_against_brute_force(spark):
    random.seed(8)
    pool = sorted({w for t in TEMPLATES for w in t.words} | {"x", "not", "never"})
    rows = []
    for i in range(250):
        parts = []
        for _ in range(random.randint(0, 5)):
            words = random.choice(TEMPLATES).words
            for _ in range(random.randint(0, 4)):
                words[random.randrange(len(words))] = random.choice(pool)
            cut = random.choice((0, 0, 2))
            parts += words[cut:] + [random.choice(pool) for _ in range(random.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    found = check(spark, rows)
    several = 0
    for i, text in rows:
        labels, score = brute_template(text, TEMPLATES)
        base = set(filter(None, found[i]["base_labels"].split(",")))
        assert set(filter(None, found[i]["labels"].split(","))) == labels | base
        assert found[i]["score"] == (1.0 if base else score)
        several += len(labels) > 1
    assert several > 30  # rows with more than one label do occur


def test_denied_licences_get_no_label(spark):
    denied = [
        "This is not the MIT License.", "It was never released under the ISC license", "neither the GNU GPL nor the BSD license",
        "this isn't under the GPL", "not licensed under the GNU General Public License version 3",
    ]
    granted = ["This is not free. It comes with a copy of the MIT License.", "MIT License, not the ISC license"]
    found = check(spark, list(enumerate([*denied, *granted, "not under the MIT license"])))
    assert [found[i]["labels"] for i in range(len(denied))] == [""] * len(denied)
    assert [found[len(denied) + i]["labels"] for i in range(2)] == ["mit", "mit"]
    assert found[len(denied) + 2]["labels"] == "mit"  # a base phrase counts wherever it stands
