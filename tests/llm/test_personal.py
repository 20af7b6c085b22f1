import hashlib
import re

from folioflow.llm import personal, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    def digits(m):
        return re.sub(r"[^0-9]", "", m.group())

    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15],
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a0159.@-+ ()%é\n_", max_size=60))
def test_base_spans_match_the_plain_patterns(text):
    assert personal.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    personal.base_spans("a" * 300_000 + "@" + "1" * 300_000 + "@x.y" + "1.1." * 50_000)


def test_query_against_brute_force(spark):
    d = SMALL
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op10_personal_data(spark, d).collect()}
    assert rows.keys() == docs.keys()
    for k, t in docs.items():
        want = brute(t)
        joined = ",".join(f"{kind}:{a}:{b}" for kind in personal.KINDS for a, b in want[kind])
        assert rows[k].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[k][f"n_{kind}"] for kind in personal.KINDS] == [len(want[kind]) for kind in personal.KINDS]
        assert set(filter(None, joined.split(","))) <= set(rows[k].spans.split(","))


def test_patterns_find_what_seeds_do_not_show(spark):
    seeds = [(i, f'word{"abcde"[i % 5]} api_key = "{hashlib.sha1(str(i).encode()).hexdigest()}" more') for i in range(40)]
    rows = [*seeds, (100, 'see api_key = "hunter2-winter" here'), (101, "the year1999x and then some"), (102, "me@a.example or +1 (202) 555-0147")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal.find(docs).collect()}
    assert found[100] == "secret:15:29" and found[101] == "" and found[102] == "email:0:12,phone:16:33"
    clean = {r.doc_id: r.text for r in personal.redact(docs).collect()}
    assert clean[100] == 'see api_key = "[SECRET]" here' and clean[101] == rows[41][1] and clean[102] == "[EMAIL] or [PHONE]"


def test_odd_rows(spark, odd_docs, no_docs):
    assert personal.find(odd_docs).count() == odd_docs.count() and personal.find(no_docs).count() == 0
    back = personal.redact(odd_docs)
    assert back.columns == odd_docs.columns and sorted(map(str, back.collect())) == sorted(map(str, odd_docs.collect()))
    assert personal.redact(no_docs).count() == 0


def test_long_tokens_are_told_apart_by_all_of_their_text():
    start = "Zz9/" * 60
    texts = [f"see {start}{end} here" for end in ("one1", "two2", "ONE1")]
    found = [personal.occurrences(t, personal.base_spans(t)) for t in texts]
    one, two, again = ([f["instance"] for f in x] for x in found)
    assert len(one) == 1 and one != two and one == again
    assert [(f["start"], f["stop"]) for f in found[0]] == [(4, 4 + len(start) + 4)]
    assert personal.known("Ab" * 100) == "ab" * 100


def test_contexts_are_whole():
    def of(text):
        at = text.index("x1y2z3")
        return personal.pattern(text, at)

    assert of("a" * 10 + "b" * 40 + " x1y2z3") != of("z" * 10 + "b" * 40 + " x1y2z3")
    assert of("key =" + " " * 60 + "x1y2z3") == of("key=x1y2z3") == of('KEY  = "x1y2z3') == "key="
    assert of("a_very_long_key_" * 3 + ": x1y2z3") == "a_very_long_key_" * 3 + ":" and of("a_very_long_key_" * 30 + ": x1y2z3").startswith("\\")
    assert of("x1y2z3") == of(" \n x1y2z3")[:1] == "~" and of("word \n\t x1y2z3") == "~word" and of("1 = x1y2z3") == "~=" and of("--k: x1y2z3") == "~--k:"
    personal.occurrences(" ".join(["k" * 5000 + " =" + " " * 5000 + "x1y2z3"] * 100), {k: [] for k in personal.KINDS})


TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/.@-]{4,}[A-Za-z0-9]")


def plain_pattern(text, start):
    left = text[:start]
    if m := re.search(r"(?<![A-Za-z_-])-*([A-Za-z_][A-Za-z_-]+) *([=:]) *[\"']?\Z", left):
        return m[1].lower() + m[2]
    m = re.search(r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+\Z", left)
    return "~" + m[1].lower() if m else "~"


def plain_find(docs):
    """[(doc_id, spans)] by the method in plain loops over dicts."""
    rows = []
    for key, text in docs:
        text = text or ""
        base = brute(text)
        taken = [s for k in base for s in base[k]]
        found = [(plain_pattern(text, a), text[a:b].lower(), k, a, b) for k in personal.KINDS for a, b in base[k]]
        for m in TOKEN.finditer(text) if re.search("[0-9]", text) else ():
            a, b = m.span()
            if re.search("[0-9]", m.group()) and not any(x < b and a < y for x, y in taken):
                v = m.group()
                secret = re.fullmatch("[0-9a-f]{16,}", v) and re.search("[a-f]", v) and len(re.findall("[0-9]", v)) >= 4
                found.append((plain_pattern(text, a), v.lower(), "secret" if secret else None, a, b))
        rows.append((key, base, found))
    kind, where = {}, {}
    for i, (_, _, found) in enumerate(rows):
        for p, v, k, _, _ in found:
            kind[p, v] = max(filter(None, (kind.get((p, v)), k)), default=None)
            where.setdefault((p, v), set()).add(i)
    degree, documents = {}, {}
    for (p, _), w in where.items():
        degree[p], documents[p] = degree.get(p, 0) + 1, documents.get(p, 0) + len(w)
    seeds = {(v, k): 1.0 for (_, v), k in kind.items() if k}
    scores, patterns = dict(seeds), {}
    for _ in range(personal.ROUNDS):
        mass, own = {}, {}
        for (p, v), k in kind.items():
            for (w, as_kind), score in scores.items():
                if w == v:
                    mass[p, as_kind] = mass.get((p, as_kind), 0) + score
                    own[p, as_kind] = own.get((p, as_kind), 0) + (k == as_kind)
        patterns = {(p, k): (m / (degree[p] + personal.SMOOTHING), own[p, k]) for (p, k), m in mass.items()}
        scores = dict(seeds)
        for (p, v), k in kind.items():
            if k is None:
                for (q, as_kind), (score, _) in patterns.items():
                    if q == p and score >= personal.CONFIDENT / 2:
                        scores[v, as_kind] = max(score, scores.get((v, as_kind), 0))
    trusted = {}
    for (p, k), (score, n) in patterns.items():
        if score >= personal.CONFIDENT and n >= personal.LEAST_SEEDS and documents[p] >= personal.LEAST_DOCUMENTS:
            trusted[p] = max(trusted.get(p, (0, "")), (score, k))
    out = []
    for key, base, found in rows:
        spans = {k: [f"{k}:{a}:{b}" for a, b in base.get(k, ())] for k in (*personal.KINDS, "secret")}
        more = [(k, a, b) for _, _, k, a, b in found if k == "secret"] + [(trusted[p][1], a, b) for p, _, k, a, b in found if k is None and p in trusted]
        for k, a, b in sorted(more):
            spans[k].append(f"{k}:{a}:{b}")
        out.append((key, ",".join(s for k in spans for s in spans[k])))
    return out


def planted():
    """Documents with seeds of three kinds in their contexts, and (doc_id, start, stop) of unseen identifiers there."""
    import random

    chance = random.Random(9)
    docs, hidden = [], []
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    shapes = {
        "api_key = ": lambda: hashlib.sha1(str(chance.random()).encode()).hexdigest(), "server: ": lambda: ".".join(str(chance.randrange(1, 255)) for _ in range(4)),
        "write to ": lambda: f"{chance.choice(words)}{chance.randrange(999)}@mail.example",
    }
    unseen = {"api_key = ": lambda: f"{chance.choice(words)}-{chance.randrange(10**6)}-Zx", "server: ": lambda: f"host-{chance.randrange(1000)}.internal", "write to ": lambda: f"user{chance.randrange(10**5)}@localhost"}
    for i in range(400):
        before = " ".join(chance.choices(words, k=chance.randrange(1, 9))) + " "
        lead = chance.choice(list(shapes))
        new = i % 10 == 0
        value = (unseen if new else shapes)[lead]()
        docs.append((i, f"{before}{lead}{value} " + " ".join(chance.choices(words, k=5))))
        if new:
            hidden.append((i, len(before + lead), len(before + lead + value)))
    # numbers of all kinds in changing contexts are no personal data
    docs += [(1000 + i, f"{chance.choice(words)} year{i}x {chance.randrange(10**6)}{chance.choice(['kg', 'km'])} v{i}.{i}.2 done") for i in range(120)]
    return docs, hidden


def test_unseen_identifiers_are_found_in_known_contexts(spark):
    docs, hidden = planted()
    got = {r.doc_id: r.spans for r in personal.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sorted(got.items()) == sorted(plain_find(docs))
    caught = [any(s.endswith(f":{a}:{b}") for s in got[i].split(",")) for i, a, b in hidden]
    assert sum(caught) / len(caught) >= 0.9
    clean = [i for i, _ in docs if i >= 1000]
    assert sum(got[i] == "" for i in clean) / len(clean) >= 0.98


def test_whole_results_against_plain_loops(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = queries.op10_personal_data(spark, SMALL).collect()
    assert sorted((r.doc_id, r.spans) for r in rows) == sorted(plain_find(docs))


def test_two_kinds_that_are_equally_likely(spark):
    docs = [(i, f"id: {'a%d@x.example' % i if i % 2 else '10.0.0.%d' % i} and") for i in range(40)] + [(50, "id: abc123def and"), (50, "id: abc123def and"), (None, "id: abc124def"), (51, None)]
    got = personal.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == sorted((str(k), s) for k, s in plain_find(docs))
