"""Quality rules, personal data, secrets: against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
from llm_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401

from starloom.llm import pii, quality_rules, queries, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_quality_measures(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for frame in (docs.select("doc_id", "text"), odd_docs):
        texts = Counter((r["doc_id"], *plain_measures(r["text"])) for r in frame.collect())
        got = quality_rules.measure(frame).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                       for r in got) == texts
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
            assert not (r["kept"] and r["base_failed"])
    assert quality_rules.measure(no_docs).count() == 0
    kept = quality_rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and quality_rules.keep_good(no_docs).count() == 0
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 1, 2]  # shouted, repeated, short and empty ones go


def test_cascade_order_follows_rejections_per_cost():
    failed = np.array([[1, 0, 1]] * 6 + [[0, 1, 0]] * 3 + [[0, 0, 0]], bool)
    assert quality_rules.order_by_rejections(failed, np.array([1.0, 1.0, 3.0])) == [0, 1, 2]
    assert quality_rules.order_by_rejections(failed, np.array([9.0, 1.0, 1.0])) == [2, 1, 0]


PII = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_pii(text):
    out = []
    for kind, pattern in enumerate(PII):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                  13 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


TRICKY = ["a@b.c@d.ef x.y@z", "1.2.3.4.5 256.1.1.1 001.002.003.255", "4111 1111-1111 1111 x 4111111111111112",
          "+1 (555) 123-4567) +12 +1-2-3", "@@a@b.c..d @a.b", "5" * 400, "", "a" * 3000 + "@" + "b" * 3000 + ".c"]


def test_base_spans_equal_plain_patterns(spark):
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for t in texts:
        assert pii.base_spans(t) == plain_pii(t)


def test_pii_query(spark, odd_docs, no_docs):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op3_pii(spark, SF_SMALL).collect():
        base = plain_pii(docs[r["doc_id"]])
        said = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert set(said) <= set(filter(None, r["spans"].split(",")))
    assert pii.digest(pii.detect(odd_docs)).count() == odd_docs.count()
    assert pii.detect(no_docs).count() == 0


def test_unmarked_phones_and_addresses_are_added_but_no_decoys(spark):
    import random
    draw = random.Random(4)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    texts = []
    for _ in range(400):  # strict ones, and numbers that are none
        texts.append(f"ask +{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)} or write to joe.{digits(2)}@mail{digits(1)}.example.com today")
        texts.append(f"the item {digits(16)} of code a{digits(9)}f and {digits(10)}e9 with 300.{digits(2)}.4.{digits(2)} in it")
        texts.append(f"he (at) his desk.Then we met look(at)it or a@b with {digits(24)} left")
    texts += [f"ring 1 (555) {digits(3)}-{digits(4)} at noon" for _ in range(40)]
    texts += [f"write to ann.{digits(2)} (at) mail.example.com soon" for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    more = {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"]:s["end"]]) for s in r["spans"] if not s["base"]]
            for r in pii.detect(docs).collect()}
    assert not any(more[i] for i in range(1200))
    assert all([k for k, _ in more[i]] == [3] and more[i][0][1].startswith("1 (555) ") for i in range(1200, 1240))
    # The generator takes no space within a name, so the span starts at the name.
    assert all([k for k, _ in more[i]] == [0] and more[i][0][1].startswith("ann.") for i in range(1240, 1280))


def test_redaction_joins_overlaps():
    assert pii.redact("call +1 555 and me", [(5, 11, 3), (6, 9, 2)]) == "call <phone> and me"


def test_secret_base_spans_equal_plain_patterns(spark):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                        r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    tricky = ["token=secret:abcdefghijklmnop", "TOKEN = 'AKIA" + "Q" * 30, "ſecret=abcdefghijklmnop", "f" * 15, "0f" * 9 + "g" + "1" * 16,
              "AKIAAKIA" + "A" * 9 + " AKIA" + "B" * 14]
    for t in tricky + [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]:
        want = [(0, *m.span()) for m in assign.finditer(t) if len(m[2]) >= 12]
        want += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert secret_scan.base_spans(t) == sorted(want, key=lambda s: (s[1], s[0]))


def test_battery_tells_random_runs_from_prose(spark, odd_docs, no_docs):
    import random
    import string
    draw = random.Random(3)
    token = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(44))
    plain = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = plain.unionByName(spark.createDataFrame([(10**6, f"see {token} and donaudampfschifffahrtsgesellschaft")], "doc_id long, text string"))
    got = {r["doc_id"]: r["spans"] for r in secret_scan.digest(secret_scan.scan(docs)).collect()}
    assert got[10**6] == f"random:4:{4 + len(token)}"
    masked = {r["doc_id"]: r["text"] for r in secret_scan.without_secrets(docs).collect()}
    assert masked[10**6] == "see <secret> and donaudampfschifffahrtsgesellschaft"
    assert sum(s.count("random") for i, s in got.items() if i != 10**6) == 0
    assert secret_scan.without_secrets(odd_docs).count() == odd_docs.count() and secret_scan.scan(no_docs).count() == 0


def test_prose_scores_cover_every_word_of_every_row(spark):
    texts = {r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()}
    texts = [*sorted(texts), "", "ab", "The Quick BROWN fox jumps " * 50]
    scores = {}
    for text in texts:
        words = re.findall("[A-Za-z]{2,15}", text)
        for c, shortest in enumerate(secret_scan.LENGTHS):
            run = ""
            for word in words:
                run += word
                if len(run) >= shortest:
                    for encoding in ("lower", "upper", "lower36", "upper36", "base32", "letters", "base62", "base64", "base64url", "any"):
                        own = run.lower() if "lower" in encoding else run.upper() if encoding in ("upper", "upper36", "base32") else run
                        scores.setdefault((encoding, c), []).append(secret_scan.departure(own, encoding))
                    run = ""
    fit = secret_scan.fit_prose(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert set(fit) == set(scores)
    for key, found in scores.items():
        assert abs(fit[key][0] - np.mean(found)) < 1e-3 and abs(fit[key][1] - max(np.std(found), 0.05)) < 1e-3


def test_prose_of_rare_rows_and_short_texts_is_known(spark):
    rows = [("",)] * 5000 + [("some quiet words of prose " * 40,)]  # one row has all the prose
    fit = secret_scan.fit_prose(spark.createDataFrame(rows, "text string"))
    assert {c for e, c in fit if e == "base62"} == set(range(5))
    short = secret_scan.fit_prose(spark.createDataFrame([("seventeen plain words",)] * 40, "text string"))
    assert short["any", 4] == short["any", 0]  # no run is longer


def test_discovery_bin_is_benjamini_hochberg():
    bins = np.zeros(400)
    bins[0], bins[100], bins[30] = 990, 8, 2
    assert secret_scan.discovery_bin(bins, 0.01) == 82  # ten ** -4.1 is the first p below 0.01 * 8 / 1000
    assert secret_scan.discovery_bin(np.zeros(400), 0.01) == 400
