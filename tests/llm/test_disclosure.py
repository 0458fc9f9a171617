import hashlib
import re

from cases import awkward, documents, prose

from daymark.llm.disclosure import all_spans, personal_data, sanitised

KINDS = ["email", "ip", "card", "phone"]


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


TEXTS = [
    "a@b.c%d@e.f.g and x.y+z@host-1.example.org, @no.one a@b a@b. a@.c é😀q@r.st",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.0003.255 1.2.3 10.0.0.1.", "9" * 30_000 + " " + "1.1.1." * 3000,
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111 1111 1111 378282246310005 0000000000000000000000",
    "call +1 (415) 555-2671 or +49.30.1234567) or +1 2 3 or ++44 20 7946 0958 +12345678901234567",
    "+4111111111111111 1@1.1.1.1 +1 415 555 2671 4111 1111 1111 1111", "", None, "no data here", "a" * 50_000 + "@b.cc",
    "x" * 200 + "@" * 3000 + "1 " * 3000,
]


def test_base_spans_equal_the_patterns(spark):
    got = {r["doc_id"]: r for r in personal_data(documents(spark, TEXTS)).collect()}
    for i, text in enumerate(TEXTS):
        spans = brute(text)
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(s[1] == j for s in spans) for j in range(4)], i
        assert got[i]["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest(), i


def test_terms_that_tell_an_entity_are_added(spark):
    def text(k, near):
        return f"{prose(k, 12)} the {near} wrote from kim@acme.example yesterday the {prose(k + 50, 12)}"

    texts = [text(k, "Zanzibaron") for k in range(4)] + [prose(k, 20) + " the yesterday wrote from" for k in range(20, 40)]
    texts += [prose(70, 5) + " other@acme.example Zanzibarona"]
    rows = {r["doc_id"]: r for r in all_spans(documents(spark, texts)).collect()}
    for k in range(4):
        assert [texts[k][s["start"] : s["end"]] for s in rows[k]["added"]] == ["Zanzibaron"]
    assert all(not rows[k]["added"] for k in range(4, len(texts)))
    clean = {r["doc_id"]: r["text"] for r in sanitised(documents(spark, texts)).collect()}
    assert "Zanzibaron wrote" not in clean[0] and "[email] yesterday" in clean[0] and clean[20] == texts[20]


def test_a_revealing_term_goes_at_every_place_of_the_text(spark):
    texts = [f"Zanzibaron {prose(k, 60)} Zanzibaron kim@acme.example {prose(k + 50, 60)} ZANZIBARON, {prose(k + 90, 5)}" for k in range(3)]
    texts += [prose(k, 20) for k in range(20, 30)]
    docs = documents(spark, texts)
    for r in all_spans(docs).where("doc_id < 3").collect():
        spots = [m.start() for m in re.finditer("zanzibaron", texts[r["doc_id"]].lower())]
        assert [s["start"] for s in r["added"] if s["value"] == "zanzibaron"] == spots and len(spots) == 3
    assert all("zanzibaron" not in r["text"].lower() for r in sanitised(docs).collect())


def test_a_name_far_from_the_entity_is_added(spark):
    """150 characters off, quoted, with a hyphen, an apostrophe or digits: the measure decides."""
    texts = [
        f"{prose(k, 10)} (O'Zanzi-Baron) agent77x {'common words of all texts ' * 6} kim@acme.example {prose(k + 50, 10)}"
        for k in range(4)
    ]
    texts += [f"{prose(k, 20)} common words of all texts" for k in range(20, 50)]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in all_spans(docs).collect()}
    for k in range(4):
        found = {texts[k][s["start"] : s["end"]] for s in rows[k]["added"]}
        assert {"O'Zanzi-Baron", "agent77x"} <= found and not found & {"common", "words", "of", "all", "texts"}
    assert all(not rows[k]["added"] for k in range(4, len(texts)))


def test_disclosure_equals_counting(spark):
    import random
    from math import log2

    r = random.Random(4)
    people, tells = [f"p{k}@x.example" for k in range(5)], [f"secret{chr(97 + k)}" for k in range(5)]
    texts = []
    for n in range(60):
        k = r.randrange(5)
        middle = f"{tells[k] if r.random() < 0.7 else 'common'} {people[k]} {r.choice(tells) if r.random() < 0.2 else ''}"
        texts.append(f"{prose(n, 30)} {middle} {prose(n + 100, 30)}")
    texts += texts[:7]  # copies count as documents and not as support
    words = [{m[0].lower() for m in re.finditer(r"[^\W_]+(?:['’-][^\W_]+)*", t)} for t in texts]
    held = [{t[a:b] for a, _, b in brute(t)} for t in texts]
    expected = [set() for _ in texts]
    for e in set().union(*held):
        holders = [i for i, h in enumerate(held) if e in h]
        for w in set().union(*[words[i] for i in holders]):
            both = [i for i in holders if w in words[i]]
            share = len(holders) / len(texts)
            p = (len(both) + share) / (sum(w in x for x in words) + 1)
            if len({texts[i] for i in both}) >= 2 and -log2(p) <= 1 and log2(p / share) >= 1:
                for i in both:
                    expected[i].add(w)
    rows = {r["doc_id"]: r for r in all_spans(documents(spark, texts)).collect()}
    assert sum(any(w.startswith("secret") for w in x) for x in expected) > 10
    for i, t in enumerate(texts):
        outside = {
            m[0].lower() for m in re.finditer(r"[^\W_]+(?:['’-][^\W_]+)*", t)
            if not any(m.start() < b and a < m.end() for a, _, b in brute(t))
        }
        assert {s["value"] for s in rows[i]["added"]} == expected[i] & outside, i


def test_awkward_rows(spark):
    df = awkward(spark)
    assert personal_data(df).count() == 15
    assert personal_data(documents(spark, [])).collect() == []
    assert sanitised(documents(spark, [])).collect() == []
    assert {r["text"] for r in sanitised(df).where("doc_id IN (4, 5)").collect()} == {""}


def test_no_python_in_the_plan(spark, sf_dir):
    from daymark.llm.queries import QUERIES

    plan = QUERIES["op10_disclosure"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
