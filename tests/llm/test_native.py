"""The operators that use SQL functions only: personal data, licences, preference formatting."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from telemetry_engine.llm import licenses, pii, preference

# --- personal data -------------------------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(int(x) for x in m[0].split(".")) > 255 or kind == "phone" and not 9 <= len(d) <= 15
                    or kind == "card" and not (12 <= len(d) <= 19 and luhn(d))):
                continue
            out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def listed(text):
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in base_spans(text))


PARTS = ["a@b.c", "_", "d@e.f", "1.2.3.4", ".", "5", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", " ", "-",
         "+1 (415) 555-2671", "+", "é", "😀", "x", "@", "..", "\n", "0", "007.08.9.1", "(", ")", "+49 30 123456"]


def test_base_spans_equal_python(documents):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += ["1" * 50_000, "1 " * 50_000, "a" * 100_000, "a@" + "b." * 30_000 + "c", "+1" + " " * 50_000 + "2", ""]
    got = pii.report(documents(list(enumerate(texts)) + [(None, None)])).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        t = "" if r["doc_id"] is None else texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(listed(t).encode()).hexdigest(), t[:100]
        kinds = [k for _, _, k, _ in base_spans(t)]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]


def test_a_term_that_gives_an_entity_away_is_found_everywhere(documents):
    rows = [(k, f"contact Zorblax at zor@blax.org now today\nline {k} of the quick fox") for k in range(2)]
    rows += [(10 + k, f"ask Zorblax {k} by zor@blax.org now") for k in range(3)]       # other lines
    rows += [(100 + k, f"now the contact of today {k} ask at line fox quick by") for k in range(200)]
    rows += [(500, "Zorblax left; zorblaxes stay"), (501, "write to zorblax@home.net")]
    got = {r["doc_id"]: r["spans"] for r in pii.report(documents(rows)).collect()}
    assert got[0] == "term:8:15,email:19:31" and got[10] == "term:4:11,email:17:29"
    assert got[500] == "term:0:7"
    assert got[501] == "email:9:25"           # within an entity: the entity's span stays
    assert all(got[100 + k] == "" for k in range(200))  # common words give nothing away
    text = {r["doc_id"]: r["text"] for r in pii.sanitised(documents(rows)).collect()}
    assert text[10] == "ask [NAME] 0 by [EMAIL] now" and text[500] == "[NAME] left; zorblaxes stay" and text[100] == rows[5][1]


def test_a_term_that_never_occurs_without_the_entity_is_removed(documents):
    rows = [(k, f"ask Zorblax {k} by zor@blax.org now") for k in range(4)] + [(9, "one more"), (10, "now ask by it")]
    rows += [(100 + k, f"now ask {k} by") for k in range(100)]
    got = {r["doc_id"]: r["spans"] for r in pii.report(documents(rows)).collect()}
    assert got[0] == "removed:4:11,email:17:29" and got[9] == got[100] == ""
    assert pii.sanitised(documents(rows)).where("doc_id = 1").first()["text"] == "ask  1 by [EMAIL] now"


def test_a_weaker_term_is_generalised(documents):
    rows = [(k, f"agent Smith {k} a@b.cd") for k in range(4)] + [(50 + k, f"Smith sold {k} pears") for k in range(3)]
    rows += [(100 + k, f"agent {k} sold pears") for k in range(300)]
    text = {r["doc_id"]: r["text"] for r in pii.sanitised(documents(rows)).collect()}
    assert text[0] == "agent [NAME] 0 [EMAIL]" and text[50] == "[NAME] sold 0 pears" and text[100] == "agent 0 sold pears"


def test_copies_of_a_line_are_one_context(documents):
    rows = [(k, "Zorblax has zor@blax.org") for k in range(50)] + [(100 + k, f"other {k}") for k in range(100)]
    assert {r["spans"] for r in pii.report(documents(rows)).collect()} == {"email:12:24", ""}


def test_copies_of_another_line_change_no_span(documents):
    rows = [(k, f"ask Zorblax {k} by zor@blax.org") for k in range(3)]
    rows += [(10 + k, f"Zorblax sold {k} pears") for k in range(7)]
    rows += [(100 + k, f"ask by other {k}") for k in range(300)]
    copies = [(1000 + k, "a line of no matter") for k in range(20_000)]
    spans = lambda more: {r["doc_id"]: r["spans"] for r in pii.report(documents(rows + more)).collect()}
    once, often = spans(copies[:1]), spans(copies)
    assert "term" not in once[10] and {i: often[i] for i in once} == once


def disclosing(texts, support=3, generalise=0.8, remove=0.95):
    """term -> kind by counting: the share of an entity's information that a term on its lines gives away."""
    lines = {x for t in texts for x in (t or "").split("\n")}
    words = lambda x: {w for w in re.findall(r"[^\W_]+", x.lower()) if len(w) >= 3}
    n_t, n_e, n_te = Counter(), Counter(), Counter()
    for x in lines:
        n_t.update(words(x))
        found, outside = base_spans(x), list(x)
        for s, _, _, e in found:
            outside[s:e] = " " * (e - s)
        held = {(k, x[s:e].lower() if k == 0 else x[s:e]) for s, k, _, e in found}
        n_e.update(held)
        n_te.update((t, e) for t in words("".join(outside)) for e in held)
    share = {}
    for (t, e), n in n_te.items():
        if n >= support and n_e[e] >= support:
            pmi = math.log2(len(lines) * n / (n_t[t] * n_e[e]))
            share[t] = max(share.get(t, 0), pmi / math.log2(len(lines) / n_e[e]))
    return {t: "removed" if x >= remove else "term" for t, x in share.items() if x >= generalise}


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_and_their_spans_equal_brute_force(documents, seed):
    rng = random.Random(seed)
    common = ["of", "the", "line", "pear", "quick", "brown", "fox", "over", "lazy", "river", "stone", "Éclair"]
    entities = [f"u{k}@mail{k}.org" for k in range(6)] + ["10.1.2.3", "10.1.2.4"]
    names = {e: f"Name{chr(65 + k)}x" for k, e in enumerate(entities)}

    def line():
        out = rng.choices(common, k=rng.randint(2, 7)) + [str(rng.randint(0, 40))]
        if rng.random() < 0.3:
            e = rng.choice(entities)
            out.insert(rng.randint(0, len(out)), e)
            if rng.random() < 0.9:
                out.insert(rng.randint(0, len(out)), names[e])
        elif rng.random() < 0.08:
            out.append(rng.choice(list(names.values())).upper())
        return " ".join(out)

    texts = ["\n".join(line() for _ in range(rng.randint(0, 5))) for _ in range(150)]
    texts += [texts[0], "", None, "nameax NAMEBX,namecx_nameDx xNameAx", "NameAx " * 3 + entities[0]]
    terms = disclosing(texts)
    assert len(set(terms.values())) == 2 and len(terms) < len(names) + 3
    for r in pii.report(documents(list(enumerate(texts)))).collect():
        t = texts[r["doc_id"]] or ""
        base = base_spans(t)
        more = [(m.start(), 4 if terms[m[0].lower()] == "term" else 5, terms[m[0].lower()], m.end())
                for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in terms
                and not any(m.start() < e and s < m.end() for s, _, _, e in base)]
        assert r["spans"] == ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(base + more)), t


def test_a_very_long_text_with_many_terms(documents):
    rows = [(10 * k + i, f"Agent{k}x wrote {i} from box{k}@mail.org") for k in range(150) for i in range(3)]
    long = " ".join(f"agent{k % 200}x then word{k % 90}" for k in range(2_000))
    got = {r["doc_id"]: r["spans"] for r in pii.report(documents([*rows, (9_999, long), (10_000, "x" * 300_000)])).collect()}
    spans = [x.split(":") for x in got[9_999].split(",")]
    assert {long[int(s):int(e)] for _, s, e in spans} == {f"agent{k}x" for k in range(150)}
    assert len(spans) == sum(k % 200 < 150 for k in range(2_000)) and got[10_000] == ""


def test_sanitised_keeps_columns_nulls_and_overlaps(documents):
    docs = documents([(1, "a@1.2.3.4 x"), (2, None), (2, None), (3, ""), (None, "+1 (415) 555-2671!")])
    out = pii.sanitised(docs)
    assert out.columns == docs.columns and out.count() == 5
    assert sorted(str(r["text"]) for r in out.collect()) == sorted(["[EMAIL] x", "None", "None", "", "[PHONE]!"])
    assert pii.report(documents([])).collect() == [] and pii.sanitised(documents([])).collect() == []


# --- licences ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def scanned(spark):
    rng = random.Random(8)
    parts = ["ka", "lo", "mi", "mit", "the", "of", "in", "under", "work", "tus", "and", "a", "is", "to", "by"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 2)))
    plain = [(k, "\n".join(" ".join(word() for _ in range(rng.randint(3, 30))) for _ in range(6))) for k in range(300)]
    notices = {
        1000: ("apache", "Intro.\nLicensed under the Apache License, Version 2.0.\nmore"),
        1001: ("mit", "Released under the MIT License."),
        1002: ("gpl", "This work is licensed under the GNU General Public License, version 3."),
        1003: ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
        1004: ("cc-by-sa", "licensed under cc by-sa 3.0"),
        1005: ("bsd", "Distributed under the BSD 3-Clause License."),
        1006: ("proprietary", "x\ny\nAll rights reserved."),
    }
    rows = plain + [(i, t) for i, (_, t) in notices.items()] + [(2000, None), (2001, ""), (2002, " \n\n"), (None, "Licensed under the MIT license."),
                                                               (1001, "Released under the MIT License."), (2003, "mit dem und der")]
    docs = spark.createDataFrame([(i, t, "f", 1.0) for i, t in rows], "doc_id long, text string, family string, probability double")
    model = licenses.train(docs, sample=300)
    return notices, licenses.scan(docs, model).collect(), model


def test_notices_are_identified_and_nothing_else(scanned):
    notices, got, model = scanned
    found = [(r["doc_id"], r["family"]) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, [*((i, f) for i, (f, _) in notices.items()), (1001, "mit"), (None, "mit")]))
    assert {r["doc_id"]: r["paragraph"] for r in got}[1006] == 2
    assert all(r["probability"] >= model.threshold and r["similarity"] >= licenses.CONFIRM for r in got)
    assert "" not in model.terms and len(model.terms) < 400


def test_an_odd_notice_is_unknown(spark, scanned):
    _, _, model = scanned
    docs = spark.createDataFrame([(1, "Licensed under the Zebra Commons Public Agreement of 1987, version twelve, license")], "doc_id long, text string")
    got = licenses.scan(docs, model).collect()
    assert [r["family"] for r in got] in ([], [licenses.UNKNOWN])
    assert licenses.scan(docs.limit(0), model).collect() == []


# --- preference formatting -----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, prompt string"


def chat(i, *turns):
    return [(i, k, r, t, "clash") for k, (r, t) in enumerate(turns)]


def rendered(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_pairs_prompts_and_masks(spark):
    u, a, s = (lambda t: ("user", t)), (lambda t: ("assistant", t)), ("system", "be kind")
    rows = chat(1, s, u("hi"), a("hello"), u("why?"), a("because é"), u("ok"))
    rows += chat(2, s, u("hi"), a("hey")) + chat(3, u("alone"), a("yes")) + chat(4, u("none"))
    rows += chat(5, s) + chat(6, u("x"), a("same"), u("y"), a("same"))
    rows += [(None, 0, "user", "lost", "c"), (7, None, None, None, "c"), (7, 1, "assistant", None, "c"), (7, 1, "assistant", "b", "c")]
    random.Random(1).shuffle(rows)
    got = {(r["kind"], r["chosen_id"], r["rejected_id"]): r for r in preference.preferences(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {("reply", 1, 1), ("reply", 7, 7), ("opening", 1, 2), ("opening", 1, 5)}
    r = got["reply", 1, 1]
    assert r["prompt"] == "".join(rendered(*t) for t in (s, u("hi"), a("hello"), u("why?"))) and r["prompt_turns"] == 4
    assert r["chosen"] == rendered("assistant", "because é") and r["rejected"] == rendered("assistant", "hello")
    spans = lambda text, at: [text[x["start"]:x["end"]] for x in at]
    assert spans(r["chosen"], r["chosen_spans"]) == ["because é<|end|>"]
    assert spans(r["rejected"], r["rejected_spans"]) == ["hello<|end|>"]
    r = got["opening", 1, 2]
    assert r["prompt_turns"] == 2 and spans(r["chosen"], r["chosen_spans"]) == ["hello<|end|>", "because é<|end|>"]
    assert r["prompt"] + r["rejected"] == "".join(rendered(*t) for t in (s, u("hi"), a("hey")))
    r = got["opening", 1, 5]  # one begins with all of the other
    assert r["rejected"] == "" and r["rejected_spans"] == [] and r["prompt_turns"] == 1
    assert got["reply", 7, 7]["prompt"] == rendered("unknown", "") + rendered("assistant", "")


def test_a_popular_opening_is_spread_and_whole(spark, monkeypatch):
    monkeypatch.setattr(preference, "PAIRS_PER_SALT", 7)
    rows = [x for k in range(60) for x in chat(k, ("user", "hi"), ("assistant", f"answer {k}"))]
    got = preference.preferences(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r["chosen_id"], r["rejected_id"]) for r in got) == [(0, k) for k in range(1, 60)]
    assert {r["rejected"] for r in got} == {rendered("assistant", f"answer {k}") for k in range(1, 60)}


def test_no_conversations(spark):
    assert preference.preferences(spark.createDataFrame([], TURNS)).collect() == []


def test_native_plans_hold_no_python(spark, documents, scanned):
    docs = documents([(1, "a@b.cd Zor")] * 3)
    turns = spark.createDataFrame(chat(1, ("user", "hi"), ("assistant", "a"), ("assistant", "b")), TURNS)
    for df in (pii.report(docs), preference.preferences(turns), licenses.scan(docs, scanned[2])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_licences_of_a_corpus_without_ordinary_text(documents):
    texts = [t for own in licenses.TEMPLATES.values() for t in own]
    for rows in ([], [(1, None), (2, "")], [(1, texts[0])] * 3, [(n, t) for n, t in enumerate(texts)]):
        docs = documents(rows)
        got = licenses.scan(docs, licenses.train(docs)).collect()
        assert {r.doc_id for r in got} == {i for i, t in rows if t}


def test_a_common_line_does_not_fill_the_sample_of_ordinary_text(documents, words):
    docs = documents([(n, words(12, 5)) for n in range(400)] + [(1000 + n, words(12, 100 + n)) for n in range(40)])
    model = licenses.train(docs, sample=30)
    assert licenses.scan(docs, model).count() == 0
