import random
import re

from brute import docs  # noqa: F401
from areastats.llm.license_rules import BASE, all_rules
from areastats.llm.license_scan import Found, Scanner, find_licenses, license_report, resolved, without_licenses

PHRASES = {tuple(p.split()): label for label, _, p in (line.split(" | ") for line in BASE.strip().splitlines())}


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base_places(text):
    w = words(text)
    return sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p)


def report(spark, docs, rows, **more):
    return {r.doc_id: r for r in license_report(docs(rows, **more)).collect()}


TEXTS = [
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. All rights reserved",
    "cc by, CC-BY; ccby cc  \n by",
    "General public license general PUBLIC licence general public license",
    "ALL RIGHTS RESERVED all rights reserved all rights",
    "Copyright (c) 2019 by us. Tous droits réservés.",
    "nothing of the kind, mit reserved",
    "",
    None,
]


def test_base_places_are_those_of_a_plain_search(spark, docs):
    rows = list(enumerate(TEXTS)) + [(100, " x ".join(t or "" for t in TEXTS) * 50)]
    out = report(spark, docs, rows, spans="x", label=1)
    for i, text in rows:
        places = base_places(text)
        r = out[i]
        assert (r.n_words, r.n_base) == (len(words(text)), len(places)), text
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and r.labels == ",".join(sorted(r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_labels_of_the_method(spark, docs):
    out = report(spark, docs, list(enumerate(TEXTS)))
    want = ["mit", "apache-2.0", "gpl,gpl-3.0", "cc-by,cc-by-nc-4.0,reserved", "cc-by"]
    assert [out[i].labels for i in range(5)] == want
    assert out[7].labels == "copyright,reserved" and out[8].labels == "" and out[9].labels == "" and out[10].n_words == 0
    assert out[0].score > 0.9 > out[7].score > 0


def test_suppression_against_all_pairs():
    rules = all_rules()
    by_level = {n: [r for r in rules if r.level == n and not r.base][:3] for n in (1, 2, 3)}
    found = [Found(by_level[1 + (7 * a + b) % 3][(a * b) % 3], a, a + b) for a in range(0, 40, 3) for b in (1, 2, 5, 9)]
    found += found[:5]

    def around(g, f):
        return g.start <= f.start and g.end >= f.end

    kept = []
    for level in (3, 2, 1):
        own = [f for f in found if f.rule.level == level]
        for i, f in enumerate(own):
            beaten = any(
                around(g, f) and ((g.start, g.end) != (f.start, f.end) or (g.rule.order, j) < (f.rule.order, i))
                for j, g in enumerate(own)
            )
            if not beaten and not any(g.rule.level > level and (around(g, f) or around(f, g)) for g in kept):
                kept.append(f)
    key = lambda f: (f.start, f.end, f.rule.order)
    assert sorted(resolved(found), key=key) == sorted(kept, key=key) and len(kept) > 10


def example(parsed):
    """Some text that the parsed pattern matches."""
    out = ""
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(value)
        elif name == "IN":
            out += example([random.choice(value)])
        elif name == "CATEGORY":
            out += "7" if "DIGIT" in str(value) and "NOT" not in str(value) else "q"
        elif name == "RANGE":
            out += chr(random.randint(*value))
        elif name == "BRANCH":
            out += example(random.choice(value[1]))
        elif name == "SUBPATTERN":
            out += example(value[3])
        elif name == "MAX_REPEAT":
            low, high, inner = value
            out += "".join(example(inner) for _ in range(random.randint(low, min(high, low + 2))))
    return out


def test_keywords_are_part_of_every_match():
    """So the prefilter loses nothing."""
    random.seed(1)
    scanner = Scanner()
    assert len(scanner.rules) > 250 and len({(r.label, r.pattern.pattern) for r in scanner.rules}) == len(scanner.rules)
    for rule in scanner.rules:
        for _ in range(25):
            text = example(re._parser.parse(rule.pattern.pattern)).encode("latin-1")
            assert rule.pattern.search(b" " + text + b" ")
            assert rule.keywords <= set(text.split()), (rule.label, text)
            assert rule in [f.rule for f in scanner.scan(text.split())], (rule.label, text)


def test_spans_long_texts_and_filter(spark, docs):
    long = "wört " * 200_000 + "MIT License " + "x" * 500_000 + " cc by " + "all rights reserved " * 2000
    rows = [(1, long), (1, long), (2, "free"), (None, "mit license")]
    found = find_licenses(docs(rows)).collect()
    spans = {(r.doc_id, len(r.spans)) for r in found}
    assert spans == {(1, 2002), (2, 0), (None, 1)}
    one = next(r for r in found if r.doc_id == 1)
    assert [(s.label, s.start, s.end) for s in one.spans[:2]] == [("mit", 200_000, 200_002), ("cc-by", 200_003, 200_005)]
    assert [r.doc_id for r in without_licenses(docs(rows, spans=1), ["mit"]).collect()] == [2]
    assert license_report(docs([])).collect() == [] and without_licenses(docs([]), ["mit"]).count() == 0
