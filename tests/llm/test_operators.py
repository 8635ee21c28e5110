"""Every operator against a plain restatement, on the smallest tables plus awkward rows."""

import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from rewardlake.llm import jaccard, order_minhash
from rewardlake.llm.common import read_documents
from rewardlake.llm.queries import REGISTRY

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

FRAGMENTS = [
    "a@b.com", "x.y", "@", "_z@q.org", "1.2.3.4", "999.1.2.3.4", ".", "4111 1111 1111 1111", "4111111111111111", "5", "-",
    " ", "  ", "\n", "\t", "+1 (706) 555-3138", "+49 30 123456", "é", "日本", "GB82 WEST 1234 5698 7654 32", "%", "password",
    "TOKEN", "api_key", "=", ":", '"', "secret", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "<|endoftext|>", "<|endof", "don't",
    "😀", "!!", " \n ", "\x1c", "\x85", "ß", "Ж", "\r\n", "IDIOT", "the"]


def awkward() -> list[tuple]:
    """Random joins of fragments, nulls in any column, empty and long texts, ties and repeated rows."""
    rng = random.Random(11)
    texts = ["".join(rng.choices(FRAGMENTS, k=rng.randint(0, 25))) for _ in range(300)]
    texts += ["", " \n\t", "x" * 30_000, "word " * 20_000, "7" * 20_000, "a@" * 5_000, "same text here now", "same text here now"]
    rows = [(1_000 + i, t) for i, t in enumerate(texts)] + [(None, "same text here now"), (None, None), (5_000, None)]
    rows += [(6_000, "one id, two texts"), (6_000, "two texts, one id"), (6_001, "a repeated row"), (6_001, "a repeated row")]
    return rows


@pytest.fixture(scope="module")
def docs():
    small = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    return small + awkward()


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    """Tables with extra columns, whose names clash with those that the operators use."""
    d = str(tmp_path_factory.mktemp("odd"))
    extra = [(i, t, None if (i or 0) % 7 == 0 else "en", "s1", None if t is None else len(t), "x", 1, 2.0, True, "y")
             for i, t in docs]
    spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, block string, sid int, "
                          "score double, held_out boolean, _row string").repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    more = spark.createDataFrame([(1001, None, None), (None, 1, 0), (999_999, 1, 1)], "doc_id long, quality int, toxic int")
    labels.unionByName(more.select("doc_id", "quality", "toxic")).write.parquet(f"{d}/labels.parquet")
    spark.read.parquet(f"{SF_SMALL}/conversations.parquet").write.parquet(f"{d}/conversations.parquet")
    return d


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").filter("1 = 0").write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    done = {}

    def of(name):
        if name not in done:
            done[name] = REGISTRY[name](spark, sf_dir).collect()
        return done[name]
    return of


def by_row(rows, docs, *columns):
    """Rows with the text that each belongs to; several texts under one id are told apart by the caller."""
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in docs)
    return [(r, texts[r["doc_id"]]) for r in rows]


def matches(rows, docs, expected):
    """Every row equals what ``expected`` says for one of the texts with its id, each text once."""
    want = Counter((i, expected(i, t or "")) for i, t in docs)
    assert Counter(rows) == want


def spans_text(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text, kinds):
    return [(m.start(), no, m.end(), name) for no, (name, pattern, ok) in enumerate(kinds)
            for m in re.finditer(pattern, text) if ok(m)]


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m[0].split("."))),
       ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
SECRETS = [("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            lambda m: len(m[2]) >= 6),
           ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]


@pytest.mark.parametrize(("query", "kinds"), [("op1_pii", PII), ("op3_secret_scan", SECRETS)])
def test_base_spans(run, docs, query, kinds):
    rows, names = run(query), [k for k, _, _ in kinds]

    def expected(_, text):
        spans = base_spans(text, kinds)
        return (*(sum(s[3] == n for s in spans) for n in names), hashlib.sha256(spans_text(spans).encode()).hexdigest())
    matches([(r["doc_id"], (*(r[f"n_{n}"] for n in names), r["base_sha256"])) for r in rows], docs, expected)
    assert sum(r[f"n_{names[0]}"] for r in rows) > 5


def test_added_spans(run):
    found = {s.split(":")[0] for r in run("op1_pii") for s in r["spans"].split(",")}
    assert "iban" in found  # passes modulo 97


def tokens(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text)) + ["\n"]


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def test_language_model(run, docs):
    rows, counts = run("op2_lm_scoring"), Counter()
    for i, t in docs:
        if crc(i) % 7 != 2:
            counts.update(tokens(t or ""))
    n, v = sum(counts.values()), len(counts)

    def expected(i, text):
        w = tokens(text)
        return (crc(i) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), n,
                round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 3))
    matches([(r["doc_id"], (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)))
             for r in rows], docs, expected)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in rows)


def test_quality_and_toxicity(run, docs):
    for name, folds, out, cut, label in (("op4_quality_classifier", 4, 2, 0.7, "quality"), ("op6_toxicity", 5, 0, 0.5, "toxic")):
        rows = run(name)
        by_row(rows, docs)
        truth = dict(duckdb.sql(f"select doc_id, {label} from '{SF_SMALL}/labels.parquet'").fetchall())
        for r in rows:
            assert r["held_out"] == (crc(r["doc_id"]) % folds == out)
            assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut)
        known = [r for r in rows if r["doc_id"] in truth and not r["held_out"]]
        assert sum(r["predicted"] == truth[r["doc_id"]] for r in known) >= 0.9 * len(known)


def test_packing(run, docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for i, text in docs:
        ids[i].append(t.encode(text or "", add_special_tokens=False).ids + [1])
    rows, sequences = run("op5_harmonic_packing"), defaultdict(list)
    lengths = Counter()
    for r in rows:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(array("I", x[r["start"]:r["start"] + r["length"]]).tobytes()) == r["ids_crc32"]
                   for x in ids[r["doc_id"]])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: sum(map(len, x)) for i, x in ids.items()}
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.01 * sum(lengths.values())


def test_bpe(run, docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def expected(_, text):
        ids = t.encode(text, add_special_tokens=False).ids
        return (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    matches([(r["doc_id"], (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])) for r in run("op7_bpe_words")], docs, expected)


def test_fingerprints(run, docs):
    rows = run("op8_order_minhash")
    single = {i: t or "" for i, t in docs if i is not None and i < 5_000}  # one text an id, and so is the next
    order = sorted(single)
    for r in rows:
        if r["doc_id"] in single and r["doc_id"] != order[-1]:
            text, after = single[r["doc_id"]], single[order[order.index(r["doc_id"]) + 1]]
            q = len(text) // 4
            edited = text[:len(text) - q] + after[:q]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in docs)
    prints = defaultdict(set)
    for r in rows:
        prints[single.get(r["doc_id"])].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for text, p in prints.items() if text is not None)
    assert len({next(iter(p)) for t, p in prints.items() if t and re.search(WORD, t)}) > 0.95 * len(prints) - 20
    long = [r for r in rows if (r["n_chars"] or 0) > 2_000 and r["doc_id"] is not None and r["doc_id"] < 1_000]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.25 > 0.05 > sum(r["near_next"] for r in long) / len(long)


def test_fingerprints_follow_order(spark):
    """Same k-mers, other order; and other numbers of one k-mer."""
    words = [f"w{i}" for i in range(200)]
    blocks = [words[i:i + 4] for i in range(0, 200, 4)]
    moved = [w for b in reversed(blocks) for w in b]
    texts = [" ".join(words), " ".join(words), " ".join(moved), "a b c " * 5, "a b c " * 80]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    f = {r["i"]: set(r["f"]) for r in order_minhash.with_fingerprint(df, "t", "f").collect()}
    assert f[0] == f[1] != f[2] and f[3] != f[4]


def jaccard_classes(docs, width, num, den):
    """(set size, class) by id, from all pairs that share a shingle."""
    sets = []
    for i, t in docs:
        w = tokens(t or "")[:-1]
        sets.append((i, frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width
                     else frozenset([tuple(w)]) if w else frozenset()))
    parent, where = list(range(len(sets))), defaultdict(list)

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    links = 0
    for a, (_, x) in enumerate(sets):
        common = Counter(b for shingle in x for b in where[shingle])
        for b, n in common.items():
            if den * n >= num * (len(x) + len(sets[b][1]) - n):
                links += 1
                parent[find(a)] = find(b)
        for shingle in x:
            where[shingle].append(a)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, len(x), least.get(find(a)) if x else i) for a, (i, x) in enumerate(sets)], links


def test_jaccard(run, docs):
    want, _ = jaccard_classes(docs, 3, 9, 10)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in run("op9_ngram_jaccard")) == Counter(want)


@pytest.mark.parametrize(("width", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_jaccard_near_copies(spark, monkeypatch, width, num, den):
    """Groups of copies with a few changes, of many sizes, in chunks of a few sets."""
    monkeypatch.setattr(jaccard, "UNIT_SETS", 8)
    rng, docs = random.Random(5), []
    for _ in range(40):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 40)}" for _ in range(rng.choice([1, 2, 4, 6, 8, 10, 12, 15, 20, 30, 60, 200, 500]))]
        for _ in range(20):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 15))):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 5)}"
            docs.append((len(docs), " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    link = jaccard.Link(width, num, den)
    got = jaccard.near_duplicates(spark, df, link).collect()
    want, links = jaccard_classes(docs, width, num, den)
    assert links > 50 and Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(want)
    kept = {r["doc_id"] for r in jaccard.keep_one(spark, df, link).collect()}
    assert kept == {c for _, _, c in want}


def brute_stats(text):
    w = re.findall(WORD, text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_rules(run, docs):
    def expected(_, text):
        s = brute_stats(text)
        return (*s, s[0] < 50 or 100 * s[4] > 50 * s[0])
    rows = run("op10_quality_rules")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    matches([(r["doc_id"], tuple(r[n] for n in names)) for r in rows], docs, expected)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    truth = dict(duckdb.sql(f"select doc_id, quality from '{SF_SMALL}/labels.parquet'").fetchall())
    fine = [r for r in rows if truth.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in fine) >= 0.95 * len(fine)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_table(spark, empty_dir, name):
    assert REGISTRY[name](spark, empty_dir).count() == 0


def test_documents_need_no_file(spark, docs):
    """A frame that is no file scan gives the same classes and ids."""
    from rewardlake.llm.bpe_words import encode

    df = spark.createDataFrame(docs[:50], "doc_id long, text string").filter("doc_id < 40")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: bytes(r["ids"]) for r in encode(spark, df).collect()}
    assert got == {i: array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for i, x in docs[:40]}
    assert read_documents(spark, SF_SMALL).count() == 200
