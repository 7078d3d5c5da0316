import hashlib
import random
import re

import pytest

from sieveline.llm import personal_data as pd_

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }
    joined = ",".join(f"{k}:{s}:{e}" for k, spans in kinds.items() for s, e in spans)
    return tuple(len(kinds[k]) for k in pd_.KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined


def check(rows, texts):
    data = list(enumerate(texts))
    got = pd_.digest(pd_.extract(rows(data, "doc_id long, text string"))).collect()
    assert len(got) == len(data)
    for r in got:
        counts, digest, joined = brute(texts[r.doc_id])
        assert ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) == (counts, digest), (texts[r.doc_id], r, joined)
        assert r.spans.startswith(joined)


def test_base_spans_equal_brute_force(spark, rows):
    pick = random.Random(5)
    parts = ["a@b.c", "a@b", "x.y+z@q-r.example.com", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111-1111 1111", "4111111111111112", "+1 (234) 567-8901", "+49", "+1234567890123456", "++1 23456789 ", "5", " ", "-", "é🎉", "\n", "_", "%", "phone: ", "a", "漢", "(", ")"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 14))) for _ in range(1500)]
    check(rows, texts + [None, "", "a@b.com_foo@y.z", "٣٤٥", "１２７.0.0.1"])


def test_whole_long_texts(spark, rows):
    check(rows, ["4" * 30_000, "a" * 60_000 + "@b.c", "1.1.1.1 " * 3000, "x@y." * 5000, "+1 " + "2 " * 20_000, "word " * 20_000 + "mail me@there.org", "1-" * 20_000, "." * 30_000])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: brute(r.text)[:2] for r in docs.collect()}
    got = {r.doc_id: ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) for r in pd_.digest(pd_.extract(docs)).collect()}
    assert got == want


def test_contexts_lead_to_unseen_identifiers(spark, rows):
    texts = [f"some words here, call tel: +1 (234) 567-89{i:02d} today" for i in range(12)]
    texts += ["reach us, tel: 030-998877 soon", "no cue 030-998877 here", "in room 12 of the house"]
    texts += [f"the +1 (234) 567-77{i:02d} and the dog, the cat, the 404 page" for i in range(8)]  # a cue that mostly stands elsewhere
    got = {r.doc_id: r.spans for r in pd_.digest(pd_.extract(rows(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    start = texts[12].index("030")
    assert got[12] == f"found:{start}:{start + 10}"
    assert got[13] == got[14] == ""
    assert all("found" not in got[i] for i in range(15, 23))
    assert all(got[i].startswith("phone:") for i in range(12))


def test_found_identifiers_are_whole(spark, rows):
    texts = [f"call {cue}: +1 (234) 567-{i:04d} today" for cue in ("tel", "tel2") for i in range(400)]
    whole = ["030 99 88 77", "030-99 88-77", "(030) 998877", "(030)99 88 77", "0049 (30) 998877", "DE89 3704 0044 0532", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606", "030/998877", "030-998877"]
    cases = [(f"my tel: {w}{end}", w) for w in whole for end in ("", " soon", ". 12 of them", ", 12", "! Then", " 5th floor")]
    cases += [(f"my tel2: {w} soon", w) for w in whole]
    cases += [("tel: 030 99 88 10.0.0.1 x", "030 99 88"), ("tel: 030 99 +1 (234) 567-8900", "030 99"), ("tel: 030 998 a@b.co", "030 998"), ("tel: 030 77 5@b.co", "030 77")]
    got = {r.doc_id: r.spans.split(",") for r in pd_.digest(pd_.extract(rows(list(enumerate(texts + [t for t, _ in cases])), "doc_id long, text string"))).collect()}
    for i, (text, value) in enumerate(cases, len(texts)):
        s = text.index(value)
        assert [x for x in got[i] if x.startswith("found")] == [f"found:{s}:{s + len(value)}"], (text, got[i])


def test_trust_spreads_over_values(spark, rows):
    """A value found behind a learned cue makes a second cue credible in the next round."""
    texts = [f"write tel: +1 (234) 567-89{i:02d} now" for i in range(30)]
    texts += [f"tel: 030-9988{i:02d}" for i in range(6)] + [f"fon= 030-9988{i:02d}" for i in range(6)]
    texts += ["fon= +1 (234) 567-8901", "fon= 040-112233"]
    df = rows(list(enumerate(texts)), "doc_id long, text string")
    run = lambda n: {r.doc_id: r.spans for r in pd_.digest(pd_.extract(df, rounds=n)).collect()}
    first, third = run(1), run(3)
    assert first[43] == "" and third[43] == "found:5:15"


def test_cues_without_seeds_are_learned_until_none_is_added(spark, rows):
    """Each cue stands mostly before values of the cue before it; only the first has base matches."""
    texts = [f"tel: +1 (234) 567-{i:04d}" for i in range(400)] + [f"tel: 030-9000{i:02d}" for i in range(6)]
    for k, cue in enumerate(("fona", "fonb", "fonc", "fond")):
        texts += ["; ".join([f"{cue}= 030-9{k}00{i:02d}"] * 30 + [f"{cue}= 030-9{k + 1}00{i:02d}"]) for i in range(6)]
    texts += [f"{cue}= 040-112233" for cue in ("fona", "fonb", "fonc", "fond", "other")]
    df = rows(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pd_.digest(pd_.extract(df)).collect()}
    last = len(texts) - 5
    assert [got[last + k] for k in range(5)] == ["found:6:16"] * 4 + [""]


def test_masked_texts(spark, rows):
    df = rows([(1, "mail a@b.co or 1.2.3.4!", "x"), (1, "plain", "x"), (None, None, "y")], "doc_id long, text string, spans_ string")
    from pyspark.sql import functions as F

    found = pd_.extract(df).select("row", "spans")
    got = df.withColumn("row", F.monotonically_increasing_id()).join(found, "row").select("doc_id", pd_.mask(df, "text").alias("t")).collect()
    assert {(r.doc_id, r.t) for r in got} == {(1, "mail <email> or <ip>!"), (1, "plain"), (None, None)}
    overlap = rows([("+1 4111111111111111 x", [("card", 3, 19), ("phone", 0, 19)])], "text string, spans array<struct<kind:string,s:int,e:int>>")
    assert overlap.select(pd_.mask(overlap, "text").alias("t")).first().t == "<phone> x"


def test_empty_table_and_plan(spark, rows):
    assert pd_.digest(pd_.extract(rows([], "doc_id long, text string"))).count() == 0
    plan = pd_.digest(pd_.extract(rows([(1, "a@b.c")], "doc_id long, text string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("value, good", [("4111111111111111", True), ("4111111111111112", False), ("0" * 13, True)])
def test_check_digit(spark, rows, value, good):
    from pyspark.sql import functions as F

    assert rows([(value,)], "v string").select(pd_._luhn(F.col("v"))).first()[0] is good


def test_cues_of_any_length(spark, rows):
    """A cue is the whole word and the blanks before the value, however long."""
    word, blanks = "x" * 120 + ":", "\t" + " " * 90
    data = [(i, f"{word} +49 30 22345{i:03d} now") for i in range(100)] + [(200 + i, f"fax{blanks}+49 30 32345{i:03d} now") for i in range(100)]
    data += [(300 + i, f"{word} 030-4455{i:02d} now") for i in range(20)] + [(400 + i, f"fax{blanks}030-5566{i:02d} now") for i in range(20)]
    got = {r.doc_id: r.spans for r in pd_.digest(pd_.extract(rows(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    start = texts[12].index("030")
    assert got[12] == f"found:{start}:{start + 10}"
    assert got[13] == got[14] == ""
    assert all("found" not in got[i] for i in range(15, 23))
    assert all(got[i].startswith("phone:") for i in range(12))


def test_found_identifiers_are_whole(spark, rows):
    texts = [f"call {cue}: +1 (234) 567-{i:04d} today" for cue in ("tel", "tel2") for i in range(400)]
    whole = ["030 99 88 77", "030-99 88-77", "(030) 998877", "(030)99 88 77", "0049 (30) 998877", "DE89 3704 0044 0532", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606", "030/998877", "030-998877"]
    cases = [(f"my tel: {w}{end}", w) for w in whole for end in ("", " soon", ". 12 of them", ", 12", "! Then", " 5th floor")]
    cases += [(f"my tel2: {w} soon", w) for w in whole]
    cases += [("tel: 030 99 88 10.0.0.1 x", "030 99 88"), ("tel: 030 99 +1 (234) 567-8900", "030 99"), ("tel: 030 998 a@b.co", "030 998"), ("tel: 030 77 5@b.co", "030 77")]
    got = {r.doc_id: r.spans.split(",") for r in pd_.digest(pd_.extract(rows(list(enumerate(texts + [t for t, _ in cases])), "doc_id long, text string"))).collect()}
    for i, (text, value) in enumerate(cases, len(texts)):
        s = text.index(value)
        assert [x for x in got[i] if x.startswith("found")] == [f"found:{s}:{s + len(value)}"], (text, got[i])


def test_trust_spreads_over_values(spark, rows):
    """A value found behind a learned cue makes a second cue credible in the next round."""
    texts = [f"write tel: +1 (234) 567-89{i:02d} now" for i in range(30)]
    texts += [f"tel: 030-9988{i:02d}" for i in range(6)] + [f"fon= 030-9988{i:02d}" for i in range(6)]
    texts += ["fon= +1 (234) 567-8901", "fon= 040-112233"]
    df = rows(list(enumerate(texts)), "doc_id long, text string")
    run = lambda n: {r.doc_id: r.spans for r in pd_.digest(pd_.extract(df, rounds=n)).collect()}
    first, third = run(1), run(3)
    assert first[43] == "" and third[43] == "found:5:15"


def test_cues_without_seeds_are_learned_until_none_is_added(spark, rows):
    """Each cue stands mostly before values of the cue before it; only the first has base matches."""
    texts = [f"tel: +1 (234) 567-{i:04d}" for i in range(400)] + [f"tel: 030-9000{i:02d}" for i in range(6)]
    for k, cue in enumerate(("fona", "fonb", "fonc", "fond")):
        texts += ["; ".join([f"{cue}= 030-9{k}00{i:02d}"] * 30 + [f"{cue}= 030-9{k + 1}00{i:02d}"]) for i in range(6)]
    texts += [f"{cue}= 040-112233" for cue in ("fona", "fonb", "fonc", "fond", "other")]
    df = rows(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pd_.digest(pd_.extract(df)).collect()}
    last = len(texts) - 5
    assert [got[last + k] for k in range(5)] == ["found:6:16"] * 4 + [""]


def test_masked_texts(spark, rows):
    df = rows([(1, "mail a@b.co or 1.2.3.4!", "x"), (1, "plain", "x"), (None, None, "y")], "doc_id long, text string, spans_ string")
    from pyspark.sql import functions as F

    found = pd_.extract(df).select("row", "spans")
    got = df.withColumn("row", F.monotonically_increasing_id()).join(found, "row").select("doc_id", pd_.mask(df, "text").alias("t")).collect()
    assert {(r.doc_id, r.t) for r in got} == {(1, "mail <email> or <ip>!"), (1, "plain"), (None, None)}
    overlap = rows([("+1 4111111111111111 x", [("card", 3, 19), ("phone", 0, 19)])], "text string, spans array<struct<kind:string,s:int,e:int>>")
    assert overlap.select(pd_.mask(overlap, "text").alias("t")).first().t == "<phone> x"


def test_empty_table_and_plan(spark, rows):
    assert pd_.digest(pd_.extract(rows([], "doc_id long, text string"))).count() == 0
    plan = pd_.digest(pd_.extract(rows([(1, "a@b.c")], "doc_id long, text string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("value, good", [("4111111111111111", True), ("4111111111111112", False), ("0" * 13, True)])
def test_check_digit(spark, rows, value, good):
    from pyspark.sql import functions as F

    assert rows([(value,)], "v string").select(pd_._luhn(F.col("v"))).first()[0] is good


def test_cues_of_any_length(spark, rows):
    """A cue is the whole word and the blanks before the value, however long."""
    word, blanks = "x" * 120 + ":", "\t" + " " * 90
    data = [(i, f"call phone: +49 30 12345{i:03d} now") for i in range(30)]
    data += [(100 + i, f"{word} +49 30 22345{i:03d} now") for i in range(30)] + [(200 + i, f"fax{blanks}+49 30 32345{i:03d} now") for i in range(30)]
    data += [(300 + i, f"{word} 030-4455{i:02d} now") for i in range(20)] + [(400 + i, f"fax{blanks}030-5566{i:02d} now") for i in range(20)]
    got = {r.doc_id: r.spans for r in pd_.digest(pd_.extract(rows(data, "doc_id long, text string"))).collect()}
    for i, t in data[200:]:
        at = t.index("030-")
        assert got[i] == f"found:{at}:{at + 10}", (i, got[i])


def test_many_matches_in_one_text_take_time_in_proportion(spark, rows):
    """A megabyte of numbers, with and without base matches among them; spans and masks as in plain Python."""
    import time

    numbers = "id 7, " * 170_000
    mixed = "".join(f"id {i}, a{i}@b.org; x{i} " for i in range(40_000))
    start = time.perf_counter()
    found = pd_.extract(rows([(1, numbers), (2, mixed)], "doc_id long, text string"), keep=("doc_id", "text"))
    got = {r.doc_id: r for r in found.select("doc_id", "spans", pd_.mask(found, "text").alias("masked")).collect()}
    assert time.perf_counter() - start < 120
    mails = [(m.start(), m.end()) for m in re.finditer(r"a[0-9]+@b\.org", mixed)]
    assert [(s.s, s.e) for s in got[2].spans if s.kind == "email"] == mails
    assert len(got[1].spans) in (0, 170_000)
    out, at = [], 0
    for s in sorted(got[2].spans, key=lambda s: s.s):
        out += [mixed[at : s.s], f"<{s.kind}>"]
        at = s.e
    assert got[2].masked == "".join(out) + mixed[at:]


def test_clashing_columns_are_refused(rows):
    df = rows([(1, "a@b.org", "x", "y")], "doc_id long, text string, tokens string, Email string")
    assert pd_.extract(df).columns == ["row", "doc_id", "spans"]  # what is not kept can't clash
    for name in ("tokens", "Email"):
        with pytest.raises(ValueError, match=name):
            pd_.extract(df, keep=("doc_id", name))
