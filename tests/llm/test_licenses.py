import random
import re

import numpy as np

from tableflow.llm.licenses import (
    GAP,
    LEAST_MATCH,
    PHRASES,
    TEMPLATES,
    Scanner,
    SuffixAutomaton,
    op10_licenses,
    scan_licenses,
)
from tableflow.llm.words import LETTERS_AND_DIGITS, LOWER, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    own = words(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        for at in range(len(own) - len(wanted) + 1):
            if own[at : at + len(wanted)] == wanted:
                places.append(at)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "MIT License", "the mit-license. cc by cc by", "apache\nLICENSE gnu general public license", "mit", "license mit",
    "x " * 50 + TEMPLATES["mit"] + " y" * 20, "gnu general public gnu general public license apache license apache",
    TEMPLATES["apache"].replace("limitations", "limits"), TEMPLATES["isc"][:60], "ccby cc by-nc", "Licensed under CC BY-NC 4.0.",
    " ".join(TEMPLATES["gpl"].split()[:40]) + " [...] " + " ".join(TEMPLATES["gpl"].split()[45:]), "mit license " * 400,
]


def test_base_columns_are_those_of_brute_force(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (1, "")], "doc_id long, text string").selectExpr("*", "1 as labels", "2 as score")
    rows = scan_licenses(docs.repartition(3)).collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        assert tuple(row[1:6]) == base(TEXTS[row["doc_id"]])
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0 or not row["labels"])
    by_id = {row["doc_id"]: row for row in rows}
    assert by_id[7]["labels"] == "mit" and by_id[7]["score"] == 1.0
    assert [(s["first"], s["end"]) for s in by_id[7]["spans"]] == [(50, 50 + len(words(TEMPLATES["mit"])))]
    assert by_id[9]["labels"] == "apache" and 0.9 < by_id[9]["score"] < 1
    assert by_id[10]["labels"] == "" and by_id[12]["labels"] == "cc-by,cc-by-nc"
    assert "gpl" in by_id[13]["labels"].split(",") and len(by_id[13]["spans"]) == 1


def test_query_on_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = {doc_id: base(text) for doc_id, text in docs}
    got = {row["doc_id"]: tuple(row[1:6]) for row in op10_licenses(spark, sf_dir).collect()}
    assert got == expected and any(row[1] for row in expected.values())


def test_empty_table(no_docs):
    assert scan_licenses(no_docs).count() == 0


def test_statistics_are_the_longest_runs_of_any_template():
    rng = random.Random(1)
    for _ in range(30):
        rows = [[rng.randrange(3) for _ in range(rng.randrange(1, 15))] for _ in range(3)]
        runs = {}
        for number, row in enumerate(rows):
            for low in range(len(row)):
                for high in range(low + 1, len(row) + 1):
                    runs.setdefault(tuple(row[low:high]), set()).add((number, high))
        automaton = SuffixAutomaton(rows)
        text = [rng.randrange(4) for _ in range(60)]
        for at, (state, length) in enumerate(automaton.statistics(text)):
            best = max((n for n in range(at + 2) if tuple(text[at + 1 - n : at + 1]) in runs or n == 0))
            assert length == best
            if length:
                assert set(automaton.ends[state]) == runs[tuple(text[at + 1 - length : at + 1])]


def test_one_line_notices_are_told_apart(spark):
    texts = [
        "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0", "licensed under cc by",
        "Licensed under CC BY-NC 3.0", "Licensed under CC BY 4.0 but the data Licensed under CC BY-SA 4.0",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row["doc_id"]: row["labels"] for row in scan_licenses(docs).collect()}
    assert [got[k] for k in range(6)] == ["cc-by", "cc-by,cc-by-nc", "cc-by,cc-by-sa", "cc-by", "cc-by,cc-by-nc", "cc-by,cc-by-sa"]


def test_phrases_and_templates_of_one_word(spark):
    docs = spark.createDataFrame([(1, "under WTFPL here"), (2, "wtfpl"), (3, "x zlib y"), (4, "none")], "doc_id long, text string")
    rows = scan_licenses(docs, {"zlib": "zlib", "two": "two words"}, {"wtfpl": "wtfpl"}).collect()
    got = {row["doc_id"]: (row["n_base"], row["first_word"], row["labels"], row["score"]) for row in rows}
    assert got == {1: (1, 1, "wtfpl", 0.5), 2: (1, 0, "wtfpl", 0.5), 3: (0, None, "zlib", 1.0), 4: (0, None, "", 0.0)}


def test_licences_that_share_most_of_their_words(spark):
    two = TEMPLATES["bsd"] + " " + TEMPLATES["bsd-disclaimer"]
    texts = {
        "gpl": TEMPLATES["gpl"],
        "lgpl": TEMPLATES["lgpl"],
        "agpl": TEMPLATES["agpl"],
        "epl": "Copyright (c) 2020 someone. " + TEMPLATES["epl"] + " SPDX",
        "bsd,bsd-disclaimer": two,
        "bsd,bsd-3-clause,bsd-disclaimer": two + " " + TEMPLATES["bsd-3-clause"],
        "mit": "Copyright (c) 2020 someone " + TEMPLATES["mit"],
        "": "This program is free software; you can redistribute it",
    }
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {row["doc_id"]: row["labels"] for row in scan_licenses(docs).collect()}
    assert got == dict(enumerate(texts))


def longest_chain(scanner, template, text):
    """Words of a template that matches in order cover, over all ways to chain them: brute force."""
    own, file = words(template), words(text)
    matches = set()
    for at in range(len(file)):
        for place in range(len(own)):
            size = 0
            while at + size < len(file) and place + size < len(own) and file[at + size] == own[place + size]:
                size += 1
            if size >= LEAST_MATCH and (at == 0 or place == 0 or file[at - 1] != own[place - 1]):
                matches.add((at, place, size))
    best = 0

    def go(chain, cover):
        nonlocal best
        best = max(best, cover)
        first0, place0, size0 = chain
        for first, place, size in matches:
            if first > first0 and place > place0 and first - first0 - size0 <= GAP:
                overlap = max(0, first0 + size0 - first, place0 + size0 - place)
                if overlap < size:
                    go((first, place, size), cover + size - overlap)

    for match in matches:
        go(match, match[2])
    return best


def test_chains_are_those_of_brute_force():
    rng = random.Random(15)
    template = " ".join(f"t{rng.randrange(60)}" for _ in range(70))
    scanner = Scanner({"own": template}, {})
    ids = {word: at for at, word in enumerate(sorted(set(words(template))))}
    for _ in range(60):
        own = words(template)
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(own))
            own[at : at + rng.randrange(0, 4)] = [f"x{k}" for k in range(rng.choice([0, 1, 2, 40]))]
        text = " ".join(own[rng.randrange(20) :])
        hashes = words_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), LETTERS_AND_DIGITS, LOWER).hashes
        matches, run, start = [], [], 0
        for at, value in enumerate([*hashes.tolist(), None]):
            known = value is not None and value in set(scanner.known.tolist())
            if known:
                start = at if not run else start
                run.append(int(np.searchsorted(scanner.known, np.uint64(value))))
            elif run:
                scanner.run(run, start, [], matches)
                run = []
        _, share = scanner.chain(matches, 0.5) if matches else ({}, 0.0)
        # the scan follows the longest matches alone, so it may cover less, but never more
        want = longest_chain(scanner, template, text) / scanner.sizes[0]
        assert share <= min(1.0, want) + 1e-9 and share >= min(1.0, want) - 0.15
    assert len(ids) > 30
