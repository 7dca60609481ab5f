import hashlib
import math
import random
import re
from collections import Counter

from areastats.llm.disclosure import find_personal_data, personal_data_report, sanitise
from brute import docs, base_spans  # noqa: F401

CARD = "4539 1488 0343 6467"


def report(df, **options):
    return {r.doc_id: r for r in personal_data_report(df, **options).collect()}


def test_base_spans_against_plain_patterns(docs):
    random.seed(6)
    parts = [
        "a@b.c", "x.y@mail-1.example.com.", "@", "a@b", "1.2.3.4", "256.1.1.1", "001.2.3.255.7", "1.2.3", CARD, "4539148803436467",
        "1234567890123", "+1 (649) 555-1648", "+49", "+1+2 345 678 901", "é", "日本 🎉", "-", " ", "\n", ".", "_d@e.f", "12", "5-5 5", "x" * 30,
    ]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 12)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "1" * 5000), (1003, "a" * 50_000), (1004, "a." * 20_000 + "@x"), (1005, "1 " * 20_000), (1006, "+1" * 9000)]
    out = report(docs(rows, base=1, spans="x", th=2))
    assert len(out) == len(rows)
    for i, text in rows:
        spans = base_spans(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = out[i]
        assert r.spans == written and r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]


def corpus():
    """Two texts that name one person beside an address, and many that name neither."""
    rows = [(i, f"ordinary words about nothing number {'abcdefghij'[i % 10]}") for i in range(200)]
    rows += [(300, "Please write to Zanzibarus at zan@mail.org about ordinary words"), (301, "Zanzibarus, who has zan@mail.org, says ordinary things")]
    rows += [(302, "Zanzibarus is somewhere"), (303, "a lone Quixotica at one@mail.org")]
    return rows


def test_terms_that_reveal_an_entity(docs):
    rows = corpus()
    out = report(docs(rows))
    text = dict(rows)

    def terms(i):
        return {text[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in out[i].spans.split(",") if s) if k == "term"}

    assert "Zanzibarus" in terms(300) and "Zanzibarus" in terms(301)
    assert "ordinary" not in terms(300) and "mail" not in terms(300)
    assert out[302].spans == "" and out[303].n_term == 0  # not beside its entity; seen in one text only
    assert out[300].spans.startswith("email:")
    assert report(docs(rows), generalise=1.1, remove=1.2)[300].n_term == 0


def test_the_share_is_what_the_counts_say(docs):
    # "Zanzibarus": 3 texts of N, beside the address in 2, which stands in 2.
    n = 204
    from math import log2

    share = log2(n * 2 / (3 * 2)) / log2(n / 2)
    found = {r.doc_id: {(t.start, t.action) for t in r.terms} for r in find_personal_data(docs(corpus())).collect()}
    assert 0.75 < share < 0.95 and (16, "generalise") in found[300]


def test_copies_alone_do_not_make_a_term_revealing(docs):
    rows = [(i, "Quixotica has one@mail.org here") for i in range(20)] + [(100 + i, "words") for i in range(50)]
    assert all(r.n_term == 0 for r in report(docs(rows)).values())


def test_sanitised_texts(docs):
    rows = [*corpus(), (None, None), (900, ""), (901, f"pay {CARD} or +1 (649) 555-1648 now"), (901, "no data")]
    df = docs(rows, __marks=1, pos="x")
    out = sanitise(df)
    assert out.columns == df.columns
    texts = [(r.doc_id, r.text) for r in out.collect()]
    assert (901, "pay [CARD] or [PHONE] now") in texts and (901, "no data") in texts and (None, None) in texts
    clean = dict(t for t in texts if t[0])
    assert "[EMAIL]" in clean[300] and "Zanzibarus" not in clean[300] and "ordinary words" in clean[300]
    assert "Zanzibarus" in clean[302] and len(texts) == len(rows)


def test_repeated_rows_and_empty_tables(docs):
    out = personal_data_report(docs([(1, "a@b.c"), (1, "a@b.c"), (1, "x"), (None, "a@b.c")])).collect()
    assert sorted(r.n_email for r in out) == [0, 1, 1, 1]
    assert personal_data_report(docs([])).collect() == []


def test_terms_far_from_an_entity_and_short_ones_in_whole_documents(docs):
    filler = " ordinary words about nothing" * 10
    rows = [(i, f"ordinary words about nothing number {'abcdefghij'[i % 10]}") for i in range(200)]
    rows += [(300, f"Żyx é🎉 is the one,{filler} zan@mail.org"), (301, f"zan@mail.org,{filler} {filler} says żyx"), (302, "Now ŻYX is masked")]
    rows += [(303, f"whois 1.2.3.4 {filler}"), (304, f"{filler} whois 5.6.7.8"), (304, f"{filler} whois 5.6.7.8"), (None, None)]
    df, text = docs(rows), dict(rows)
    spans = [(r.doc_id, r.spans) for r in personal_data_report(df, context=None).collect()]
    assert len(spans) == len(rows)
    found = {i: [text[i][int(a) : int(b)].lower() for k, a, b in (x.split(":") for x in s.split(",") if x) if k == "term"] for i, s in spans}
    assert found[300] == found[301] == found[302] == ["żyx"]  # wherever it stands
    assert found[303] == found[304] == ["whois"]  # each address once, their kind twice
    assert not any(found[i] for i in range(200)) and sanitise(df, context=None).where("doc_id = 302").first().text != "Now ŻYX is masked"
    near = {r.doc_id: r.n_term for r in personal_data_report(df).collect()}
    assert near[302] == near[303] == 0


def plain_terms(rows, alpha=0.05):
    """Revealing terms of whole documents, counted in memory: the texts here hold e-mails only, as one word."""
    split = {d: (set(re.findall(r"\S+@\S+", d[1])), set(re.findall(r"[^\W\d_]+", re.sub(r"\S+@\S+", " ", d[1]).lower()))) for d in set(rows)}
    n, joint, texts, n_e, n_t = len(split), Counter(), {}, Counter(), Counter()
    for (_, text), (mails, words) in split.items():
        n_t.update(words)
        for e in [*mails, *(["kind"] if mails else [])]:
            n_e[e] += 1
            for w in words:
                joint[e, w] += 1
                texts.setdefault((e, w), set()).add(text)
    tried = [p for p in joint if len(texts[p]) >= 2]
    out = set()
    for e, w in tried:
        k, t, p = joint[e, w], n_t[w], n_e[e] / n
        if p < 1 and math.log(k / t / p) / -math.log(p) >= 0.75 - 1e-12 and k / t > p:
            q = k / t
            bound = t * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))
            if bound >= math.log(len(tried) / alpha):
                out.add(w)
    return out


def test_terms_of_whole_documents_against_plain_counts(docs):
    """Planted terms are found; of thousands of rare words, which often stand beside a mail by chance, none is."""
    random.seed(3)
    rare = ["".join(random.choices("abcdefghijklmnopqrstuvw", k=6)) for _ in range(1500)]
    rows = []
    for i in range(600):
        words = random.choices(rare, k=12)
        if i % 12 == 0:
            words += [f"p{'abcdefghij'[i // 12 % 10]}@mail.org"] + (["zyxel"] if i // 12 % 10 == 3 else []) + (["kindly"] if i % 24 == 0 else [])
        rows.append((i, " ".join(words)))
    rows += [(1000, "ask zyxel"), (1001, "kindly " * 30_000), (1002, ""), (rows[0][0], rows[0][1])]
    want = plain_terms(rows)
    assert {"zyxel", "kindly"} <= want and len(want & set(rare)) == 0
    text = dict(rows)
    out = personal_data_report(docs(rows), context=None).collect()
    spans = [(r.doc_id, *map(int, x.split(":")[1:])) for r in out for x in r.spans.split(",") if x.startswith("term")]
    assert {text[i][a:b].lower() for i, a, b in spans} == want
    assert sum(1 for i, _, _ in spans if i == 1001) == 30_000 and {i for i, _, _ in spans} >= {1000, 1001}
    assert personal_data_report(docs([]), context=None).collect() == []
