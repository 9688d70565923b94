"""The ten operators against plain second versions, and odd tables."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pyarrow.fs as pafs
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinloom.llm import langid, leaks, minhash, pseudonyms, quality, secrets, token_files, toxicity, web_archive
from clinloom.llm.registry import QUERY_KEY, WORD_BPE
from tests.llm.test_llm import ASSIGN, base_spans, counted, prose

# ---- 1


def valid_values(text):
    """Every substring that is a card number or a national id of the simple formats, by trying all of them."""
    found = []
    for a in range(len(text)):
        if a and re.match(r"[\w.+-]", text[a - 1]):
            continue
        for b in range(a + 9, min(len(text), a + 37) + 1):
            one = text[a:b]
            if re.match(r"[\w-]|\.\d", text[b:]):
                continue
            digits = re.sub("[ -]", "", one)
            if re.fullmatch(r"\d(?:[ -]?\d){12,18}", one, re.A) and len(set(digits)) > 1:
                twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
                if sum(d - 9 if d > 9 else d for d in twice) % 10 == 0:
                    found.append((a, b, "card"))
            if re.fullmatch(r"\d{4}-\d\d-\d\d", one, re.A):
                try:
                    date.fromisoformat(one)
                    found.append((a, b, "date"))
                except ValueError:
                    pass
    return found


def test_pseudonyms_find_what_brute_force_finds(spark):
    r = random.Random(11)
    permute = pseudonyms.Permutation(QUERY_KEY)
    bits = ["4111 1111 1111 1111", "5500005555555559", "2020-02-29", "1850-07-01", "12/27", " 7 ", "x", " ", "99 ", "2021-02-30", ", ", "4111-1111-1111-1112"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 6))) for _ in range(300)]
    for text in texts:
        kinds = [s for s in pseudonyms.rewrite(text, permute)[1] if s[2] in ("card", "date")]
        every = valid_values(text)
        assert set(kinds) <= set(every)
        # whatever is valid overlaps something that was found
        assert all(any(a < y and x < b for x, y, _ in kinds) or re.search(r"\d{3}[ .-]\d{3}[ .-]\d{4}", text) for a, b, _ in every)
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (0, texts[0], "x")], "doc_id long, text string, found string")
    got = pseudonyms.op1(rows, QUERY_KEY).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        new, spans = pseudonyms.rewrite(texts[row.doc_id or 0], permute)
        assert (row.text, row.n_found, row.spans) == (new, len(spans), ",".join(f"{k}:{a}:{b}" for a, b, k in spans))
    assert pseudonyms.op1(rows.limit(0), QUERY_KEY).count() == 0
    back = pseudonyms.pseudonymise(rows, QUERY_KEY)
    assert back.columns == ["doc_id", "text", "found"] and back.schema["found"].dataType.typeName() == "array"


def test_pseudonyms_of_other_centuries_times_and_long_addresses():
    permute = pseudonyms.Permutation(QUERY_KEY)
    for text in ("1850-07-01", "0001-01-01", "9999-12-31", "born 31.12.2100", "at 2020-01-01T10:00:00Z", "a" * 90 + "@example.org", "x@" + "b" * 80 + ".example.org", "q" * 500 + "@mail.example.org"):
        new, spans = pseudonyms.rewrite(text, permute)
        assert new != text and len(spans) == 1 and len(new) == len(text)
        assert pseudonyms.rewrite(new, permute, back=True)[0] == text
    assert pseudonyms.rewrite("at 2020-01-01T10:00:00Z", permute)[0].endswith("T10:00:00Z")
    first, last = pseudonyms.FIRST_DAY, pseudonyms.LAST_DAY
    for text in ("1899-12-31", "2100-01-01", "0001-01-01", "9999-12-31"):
        day = date.fromisoformat(pseudonyms.pseudonym(permute, "date", text)).toordinal()
        assert not first <= day <= last


# ---- 2


def test_archives_and_ranges_are_several(spark, monkeypatch):
    monkeypatch.setattr(web_archive, "RANGE_RECORDS", 7)
    monkeypatch.setattr(web_archive, "RANGE_BYTES", 2_000)
    r = random.Random(5)
    rows = [(i, f"http://h/{i}", prose(i % 40, r.choice([1, 30, 600]))) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    manifest = web_archive.write(pages)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == 300
    ranges = web_archive.locate(manifest).collect()
    assert len(ranges) > 40 and max(len(x.lengths) for x in ranges) <= 7
    assert all(len(x.lengths) == 1 or sum(x.lengths) <= 2_000 for x in ranges)
    read = web_archive.read(manifest)
    assert read.rdd.getNumPartitions() > 1
    got = {x.page_id: x for x in read.collect()}
    first = {}
    for i, _, h in rows:
        first.setdefault(h, i)
    assert len(got) == 300
    for i, url, h in rows:
        assert (got[i].url, got[i].payload_bytes) == (url, len(h.encode()))
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if first[h] == i else ("revisit", first[h]))


# ---- 4


def test_language_against_a_plain_bayes(spark):
    r = random.Random(12)
    tongue = {"en": "the and with that this have from", "fr": "le une avec dans être pour où", "de": "der und nicht eine über the le"}
    rows = [(i, " ".join(r.choice(tongue[k].split()) for _ in range(r.randint(1, 12))), k) for i, k in enumerate(list(tongue) * 30)]
    rows += [(900, prose(77, 4000), "en"), (901, rows[0][1], "en"), (902, "12 3", "de"), (None, "der und", "de")]

    def grams(text):
        plain = "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        return Counter(plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1) if plain[i : i + n].strip())

    counts, docs = defaultdict(Counter), Counter()
    for i, t, k in rows:
        if i is None or zlib.crc32(str(i).encode()) % 3 != 1:
            counts[k] += grams(t)
            docs[k] += 1
    total = sum(docs.values())
    frame = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, lang string, score string")
    for x in langid.op4(frame).collect():
        text = next(t for i, t, _ in rows if i == x.doc_id)
        seen = grams(text)
        if not seen:
            assert (x.lang_pred, x.score) == ("und", 0.0)
            continue
        logs = {k: math.log(docs[k] / total) + sum(n * math.log((c[g] + langid.SMOOTHING) / (c.total() + langid.SMOOTHING * langid.BUCKETS)) for g, n in seen.items()) for k, c in counts.items()}
        best = max(sorted(logs), key=logs.get)
        assert x.lang_pred == best
        assert x.score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=2e-3)


# ---- 5


def test_leaks_against_all_places(spark):
    few = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11 l12 m13".split()
    r = random.Random(1)
    docs = [" ".join(r.choice(few) for _ in range(80)) for _ in range(60)]
    items = [" ".join(r.choice(few) for _ in range(24)), "a1 m13 a1 c3", "quartz meadow ember falcon pepper willow orchid saffron", "zinc", prose(3, 60)]
    docs[5] += f" {items[0]} {items[1]} x"
    docs[9] += f" {items[0]} {items[2]} {items[3]}"
    docs += [prose(41, 3000) + " " + items[4] + " " + prose(42, 3000), prose(43, 200) + " " + items[2].replace(" ember", ""), None, "", docs[9]]
    # short items among words that weigh more than theirs
    docs.append(" ".join(items[4].split()[:20]) + " quartz meadow ember falcon pepper willow orchid saffron " + " ".join(items[4].split()[20:40]))
    number = {}
    nums = lambda words: [number.setdefault(w, len(number)) for w in words]
    sure, may = set(), set()
    for d, text in enumerate(docs):
        words = nums(leaks.words_of(text))
        for k, item in enumerate(items):
            one, answer = nums(leaks.words_of(item)), nums(leaks.answer_of(item))
            n = len(one)
            if any(words[i : i + n] == one for i in range(len(words) - n + 1)):
                sure.add((d, k))
            elif n >= leaks.SHORT:
                near = (np.array(words[max(0, i - n) : i + 2 * leaks.SEGMENT + n]) for i in range(0, len(words), leaks.SEGMENT))
                if any(leaks.common_subsequence(one, x) >= leaks._needed(n) and leaks.common_subsequence(answer, x) >= 0.5 * len(answer) for x in near):
                    may.add((d, k))
    frame = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(docs)] + [(None, docs[9], 0.5)], "doc_id long, text string, cosine double")
    benchmark = spark.createDataFrame([*enumerate(items), (7, None)], "item_id long, text string")
    found = leaks.op5(frame, benchmark).collect()
    got = {(x.doc_id, x.item_id) for x in found if x.doc_id is not None}
    assert sure <= got <= sure | may
    assert len(got) >= 0.9 * len(sure | may)
    assert {x.item_id for x in found if x.doc_id is None} == {k for d, k in got if d == 9}


def test_leaks_of_paraphrases(spark):
    r = random.Random(6)
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "li", "mu") for b in ("ran", "sel", "tip", "vor", "wem") for c in ("a", "eth", "ing", "o", "um")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [text(r.randint(15, 60)) for _ in range(60)]
    docs, want = [], set()
    for i in range(240):
        one = items[i % 60].split()
        for _ in range(len(one) // 5):  # a fifth of the words dropped, swapped or replaced
            j, kind = r.randrange(len(one) - 1), i // 60 % 3
            if kind == 0:
                del one[j]
            elif kind == 1:
                one[j], one[j + 1] = one[j + 1], one[j]
            else:
                one[j] = "other"
        answer = leaks.answer_of(items[i % 60])
        if leaks.common_subsequence(answer, np.array(one)) >= 0.5 * len(answer) and leaks.common_subsequence(items[i % 60].split(), np.array(one)) >= leaks._needed(len(items[i % 60].split())):
            want.add((i, i % 60))
        docs.append((i, f"{text(90)} {' '.join(one)} {text(90)}"))
    docs += [(1000 + i, text(200)) for i in range(200)]
    got = {(x.doc_id, x.item_id) for x in leaks.op5(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert len(want) > 200 and len(got & want) >= 0.9 * len(want)
    assert not {x for x in got if x[0] >= 1000}


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 40)
    monkeypatch.setattr(leaks, "ADDED_TASKS", 2)
    items = [prose(600 + k, 14) for k in range(9)]
    docs = spark.createDataFrame([(i, prose(i, 60) + " " + items[i % 9] + " " + prose(i + 99, 20)) for i in range(45)], "doc_id long, text string").repartition(7)
    got = {(x.doc_id, x.item_id) for x in leaks.op5(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert {(i, i % 9) for i in range(45)} <= got


# ---- 6


def linked_parts(t, reach=secrets.REACH):
    base = [(a, b, secrets.ROLES[k]) for a, _, b, k in base_spans(t)]
    weak = [(m.start(), m.end(), role) for role, p in secrets.WEAK.items() for m in re.finditer(p, t, re.A)]
    weak = [w for w in weak if not any(a < w[1] and w[0] < b for a, b, _ in base)]
    blanks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", t)]
    scope = lambda p: sum(b <= p[0] for b in blanks)
    pairs = [{"secret", "identifier"}, {"secret", "endpoint"}]
    return sorted((w[0], w[1]) for w in weak for q in base + weak if {w[2], q[2]} in pairs and scope(w) == scope(q) and max(w[0] - q[1], q[0] - w[1]) <= reach)


def test_secret_links_against_all_pairs(spark):
    r = random.Random(13)
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY9"
    bits = [key, key + "/" + key, "client_id=abc123", "username: alice", "https://api.example.com/v1", "https://example.com/blog", "postgres://db.example.com:5432", "password=hunter22x", "AKIA" + "Q" * 16, "0f" * 14, "\n\n", "\n", " ", " words " * 25, "é😀 "]
    texts = [" ".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(250)]
    texts += ["username: alice wrote at https://example.com/blog about cats", "username: alice at https://api.example.com/v1", f"user={'u' * 500} {key}", f"{key} https://api.example.com/{'p' * 900}"]
    texts += ["\n".join(f"client_id=a{i} key {key}" for i in range(300)), " ".join("0f" * 14 + f" {i}" for i in range(500))]
    rows = spark.createDataFrame([(i, t, "b", "a", "w", "s") for i, t in enumerate(texts)], "doc_id long, text string, base string, added string, weak string, scopes string")
    for row in secrets.op6(rows).collect():
        want = sorted(set(linked_parts(texts[row.doc_id])))
        assert sorted((int(a), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(",") if x) if k == "weak") == want
        assert row.n_weak == len(want)
    clean = {x.doc_id: x for x in secrets.redact(rows).collect()}
    assert clean[250].text == texts[250] and clean[251].text == texts[251]
    assert clean[252].text == "[SECRET] [SECRET]" and clean[253].text == "[SECRET] [SECRET]"
    assert (clean[0].base, clean[0].added, clean[0].weak, clean[0].scopes) == ("b", "a", "w", "s")
    odd = rows.limit(0)
    assert secrets.op6(odd).count() == 0 and secrets.redact(odd).count() == 0
    again = spark.createDataFrame([(None, texts[2]), (1, texts[2]), (1, texts[2]), (2, None)], "doc_id long, text string")
    assert len({(x.spans, x.n_weak) for x in secrets.op6(again).collect() if x.doc_id != 2}) == 1
    assert secrets.scan(rows).columns == ["doc_id", "text", "base", "added", "weak", "scopes"]
    assert ASSIGN.search("token = abcdef")


# ---- 7


def test_toxicity_scores_are_the_model_s(spark):
    r = random.Random(14)
    docs = [(i, prose(i + 100, 30) + (" vile scumbag" if i % 6 == 0 else "")) for i in range(240)]
    docs += [(6, prose(1, 10)), (300, prose(9, 4000)), (None, docs[0][1]), (301, docs[0][1])]
    labels = [(i, int(i % 6 == 0)) for i in range(0, 240, 2)] + [(None, 1), (4, None), (6, 1), (12, 0)]
    r.shuffle(docs)
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, score string, features string")
    m = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.train(d.select("doc_id", "text").where(~held("doc_id")), m.where(~held("doc_id")))
    got = toxicity.op7(d, m).collect()
    assert len(got) == len(docs)
    plain = defaultdict(list)
    for i, t in docs:
        words = set(re.findall(r"\w+", (t or "").lower()))
        grams = {xxhash.xxh32_intdigest("=" + w) for w in words} | {xxhash.xxh32_intdigest("^" + w[:n]) for w in words for n in range(3, 7) if len(w) >= n}
        plain[i].append(1 / (1 + math.exp(-(model.bias + sum(model.weight[model.index[g]] for g in grams if g in model.index)))))
    for x in got:
        assert min(abs(x.score - s) for s in plain[x.doc_id]) < 1e-9
        assert x.predicted == int(x.score >= 0.3)
    assert toxicity.op7(d.limit(0), m).count() == 0


def test_training_ids_that_repeat_are_one_row(spark):
    """A labelled id under many texts is learned from once, whatever the order of rows."""
    rows = [(1, f"text {k} here") for k in range(50)] + [(i, prose(i, 60)) for i in range(2, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    a = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    b = quality.train(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(7), labels)
    assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "limit", "left", "value", "roots"))


# ---- 8


def test_token_files_of_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(token_files, "READ_DOCS", 9)
    monkeypatch.setattr(token_files, "READ_SLICE", 4)
    texts = [prose(i, i % 37) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, "again")], "doc_id long, text string").repartition(6)
    manifest = token_files.write(docs, WORD_BPE, 1, partitions=5)
    assert manifest.count() == 5
    library, at = Tokenizer.from_file(WORD_BPE), 0
    got = sorted(token_files.read(manifest).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted([*range(200), 7])
    for row in got:
        ids = [library.encode(t, add_special_tokens=False).ids + [1] for t in ([texts[row.doc_id]] if row.doc_id != 7 else [texts[7], "again"])]
        assert row.start == at and row.ids in ids and row.n_tokens == len(row.ids)
        at += row.n_tokens


def test_numbers_are_read_by_ranges(tmp_path):
    np.arange(1000, dtype="<u8").tofile(f"{tmp_path}/x")
    for store, path in ((pafs.LocalFileSystem(), f"{tmp_path}/x"), (pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem()), "x")):
        numbers = token_files._Numbers(store, path, "<u8")
        assert (numbers.file is None) == isinstance(store, pafs.LocalFileSystem)
        assert numbers.take(10, 14).tolist() == [10, 11, 12, 13] and len(numbers.take(5, 5)) == 0


# ---- 10


def test_quality_verdict_by_walking_each_tree(spark):
    r = random.Random(15)
    texts = [prose(i, r.randint(40, 120)) + (" !!! ### " * r.randint(0, 20) if i % 3 else "") for i in range(200)] + [prose(5, 4000), None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (3, texts[3], "x")], "doc_id long, text string, features string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, quality int")
    trees = quality.train(docs, labels)

    def chance(features):
        total = trees.base
        for root in trees.roots.tolist():
            node = root
            while trees.feature[node] >= 0:
                node = int(trees.left[node]) + (features[trees.feature[node]] > trees.limit[node])
            total += trees.value[node]
        return 1 / (1 + math.exp(-total))

    got = quality.op10(docs, labels).collect()
    assert len(got) == len(texts) + 2
    for x in got:
        text = texts[x.doc_id or 0]
        n, _, _, _, repeats = counted(text)
        want = chance(quality.statistics(text)[1])
        assert x.score == pytest.approx(want, abs=1e-9)
        assert x.kept == (not (n < 50 or 100 * repeats > 50 * n) and want >= quality.KEEP_FROM)


# ---- pipeline


def test_pipeline_of_odd_tables(spark, tmp_path):
    import corpus_pipeline

    item = "quartz lantern bridge walnut ember falcon meadow thunder pepper granite willow orchid saffron juniper marble"
    long = prose(70_000, 30_000)
    texts = [(1, prose(1, 60)), (1, prose(2, 60)), (1, prose(1, 60)), (None, prose(3, 60)), (None, prose(4, 40) + " " + item + " " + prose(5, 40)), (5, long), (6, None), (7, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, base string"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")

    def run(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        benchmark.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        return corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()

    got = run("odd", [(i, t, "en", "s", 1, "k", "b") for i, t in texts])
    # both texts of id 1 stay, the clean text without id too; the one that holds the item goes
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in got) == [(False, 1), (False, 1), (False, 5), (True, 0)]
    assert sum(x.n_tokens for x in got if x.doc_id == 5) > 30_000
    assert run("empty", []) == []
    # no language to learn from: nothing is rejected for it
    assert {x.doc_id for x in run("mute", [(1, prose(1, 60), None, "s", 1, "k", "b"), (2, prose(9, 60), None, "s", 1, "k", "b")])} == {1, 2}


def test_minhash_of_clashing_columns(spark):
    rows = spark.createDataFrame([(1, prose(1, 30), 5, True), (2, prose(1, 30), 6, False), (2, prose(1, 30), 6, False)], "doc_id long, text string, component_id long, kept boolean")
    assert sorted((x.doc_id, x.component_id, x.kept) for x in minhash.near_duplicates(rows).collect()) == [(1, 1, True), (2, 1, False), (2, 1, False)]


# ---- 8, other tokenizer files


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library_for_any_file(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    assert token_files.is_known(path) == (name == "word_bpe_49k.json")
    library, own, r = Tokenizer.from_file(path), token_files.WordEncoder(path), random.Random(8)
    letters = "abcÀÉß 日\t\n'sT1<|>-._\u00a0e\u0301"
    for _ in range(300):
        text = "".join(r.choices(letters, k=r.randint(0, 40)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_file_with_other_settings_gets_no_short_cut(tmp_path):
    import json

    with open(WORD_BPE, encoding="utf-8") as f:
        given = json.load(f)
    changes = [
        lambda d: d["normalizer"]["normalizers"].pop(),
        lambda d: d["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="[a-z]+"),
        lambda d: d["model"].update(end_of_word_suffix="</x>"),
        lambda d: d["added_tokens"][0].update(content="start"),
        lambda d: d.update(truncation={"max_length": 5}),
    ]
    for n, change in enumerate(changes):
        other = json.loads(json.dumps(given))
        change(other)
        (tmp_path / f"{n}.json").write_text(json.dumps(other))
        assert not token_files.is_known(str(tmp_path / f"{n}.json"))


# ---- 5, a passage's share of the items' sums


def test_sparse_sums_are_the_dense_ones():
    r = np.random.default_rng(3)
    size, rank = 500, 16
    omega, weight = r.standard_normal((size, rank)), np.where(r.random(size) < 0.2, 0, r.random(size))
    dense, sparse = np.zeros((size, rank)), np.zeros((size, rank))
    for _ in range(50):
        words = r.integers(0, size, 24)
        v = np.bincount(words, weight[words], minlength=size)
        dense += np.outer(v, v @ omega)
        own, n = np.unique(words, return_counts=True)
        v = weight[own] * n
        sparse[own] += np.outer(v, v @ omega[own])
    assert np.allclose(dense, sparse)
