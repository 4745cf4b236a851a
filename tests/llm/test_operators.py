"""Each operator against brute force, a library or an exact round trip, on small tables."""

import base64
import hashlib
import random
import re
import struct
import textwrap

import duckdb
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ratelens.llm import decontamination, licenses, line_dedup, quality, queries, secret_scan, substring_dedup, toxicity
from ratelens.llm.bpe import bpe_encode
from ratelens.llm.simhash import BUCKET, fingerprint, links, simhash_components
from ratelens.llm.url_filter import judge_urls
from tests.compare import difference, duck

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def given(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_bpe_equals_tiktoken(spark):
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["", "a" * 3000, "aaabbbabab" * 40, "éé 日本語 １２３ ½ ²", "\x1c\x1d x\x85y   z", "<|endoftext|> it's"]
    texts = odd + [row["text"] for row in given(spark).collect()]
    for row in bpe_encode(documents(spark, texts), VOCABULARY, public_tokenizers.PATTERN, with_ids=True).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["token_ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values, distance=2):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    ordered = sorted(values)
    for n, a in enumerate(ordered):
        for b in ordered[n + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_equals_brute_force(spark):
    texts = ["", " \n", "one", "A B", "É b c\x85d e"] + [row["text"] for row in given(spark).collect()]
    expected = [brute_fingerprint(text) for text in texts]
    assert [fingerprint(text) % 2**64 for text in texts] == expected
    group = brute_components(set(expected))
    smallest = {}
    for doc_id, value in enumerate(expected):
        smallest.setdefault(group[value], doc_id)
    for row in simhash_components(documents(spark, texts)).collect():
        assert row["fingerprint"] == f"{expected[row['doc_id']]:016x}"
        assert row["component_id"] == smallest[group[expected[row["doc_id"]]]]


def test_crowded_buckets_lose_no_link(spark):
    """Fingerprints that agree in three blocks: far more than are compared at once."""
    base = 0x123456789ABCDEF0
    values = {base ^ (i * 2654435761 % 2**13) << 51 for i in range(3 * BUCKET)} | {base ^ 1 << b for b in range(64)}
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    found = links(spark.createDataFrame(signed, "fp long")).collect()
    root = {v[0]: v[0] for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for row in found:
        assert ((row["a"] ^ row["b"]) % 2**64).bit_count() <= 64
        root[find(row["a"])] = find(row["b"])
    expected = brute_components(values)
    assert len({find(v[0]) for v in signed}) == len(set(expected.values()))


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    import corpus_pipeline

    texts = ["", "one", "ONE ", None] + [row["text"] for row in given(spark).collect()]
    prints = [brute_fingerprint(text or "") for text in texts]
    group = brute_components(set(prints))
    firsts = {}
    for doc_id, value in enumerate(prints):
        firsts.setdefault(group[value], doc_id)
    kept = corpus_pipeline.near_dedup(spark, documents(spark, texts), SMALL)
    assert {row["doc_id"] for row in kept.collect()} == set(firsts.values())


def test_simhash_rejects_a_distance_without_a_block_to_join_on(spark):
    for distance in (-1, 5):
        with pytest.raises(ValueError):
            links(spark.createDataFrame([(1,)], "fp long"), distance)


def test_line_dedup_equals_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog number"
    family = [f"{base} {n:05d} and goes on to the end of it" for n in range(0, 60)]  # crowded keys
    changed = [base, base.replace("quick", "quikc"), base[1:], "é" + base[1:], base + "!!", base + "!!!", "𝒳" + base]
    texts = ["\n".join(family[:30]), "\n".join(family[30:] + changed), "short\n" + base + "\nshort", "", base]
    places = {(i, n): line for i, t in enumerate(texts) for n, line in enumerate(t.split("\n")) if len(line) >= 20}
    first = {}
    for place in sorted(places):
        first.setdefault(places[place], place)
    near = {a: [b for b in first if b != a and edits(a, b) <= 2] for a in first}
    gone = {}
    for place, line in places.items():
        if first[line] != place or any(first[other] < first[line] for other in near[line]):
            gone.setdefault(place[0], []).append(place[1])
    rows = {row["doc_id"]: row for row in line_dedup.repeated_lines(documents(spark, texts)).collect()}
    assert {i: row["repeated"] for i, row in rows.items() if row["repeated"]} == {i: sorted(x) for i, x in gone.items()}
    assert sum(row["n_links"] for row in rows.values()) == sum(len(near[line]) for line in places.values())
    kept = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert kept[i] == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone.get(i, []))


@pytest.mark.parametrize("k", [1, 2])
def test_a_family_of_near_lines_loses_no_link(spark, k, monkeypatch):
    """Lines that crowd their keys: a few letters or words away from one of them, in one place or more, or long repeats."""
    rng = random.Random(k)
    base = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(2, 8))) for _ in range(20))
    lines = {base, "ab" * 60, "ab" * 59 + "a", "b" + "ab" * 59, "ab" * 61}
    while len(lines) < 200:
        line = base if rng.random() < 0.9 else "ab" * 60
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            at = rng.randrange(len(line) + 1) if rng.random() < 0.7 else rng.choice([0, 5, 60, len(line)])
            new = "".join(rng.choice("abxy ") for _ in range(rng.choice([0, 1, 1, 2, 3, 6])))
            line = line[:at] + new + line[at + rng.choice([0, 0, 1, 1, 2, 3, 6]) :]
        lines.add(line)
    lines = sorted(lines)
    near = {(a, b) for n, a in enumerate(lines) for b in lines[n + 1 :] if abs(len(a) - len(b)) <= k and edits(a, b) <= k}
    table = spark.createDataFrame([("x", line) for line in lines], "key string, line string")
    found = {tuple(sorted(pair)) for pair in line_dedup.crowded_pairs(table, k).collect()}
    assert near <= found and len(near) > 30
    assert len(found) < len(lines) ** 2 / 6
    monkeypatch.setattr(line_dedup, "LEVELS", 0)
    pairs = line_dedup.near_pairs(table.select("line"), line_dedup.Lines(edits=k)).collect()
    assert {tuple(sorted(pair)) for pair in pairs} == {(a, b) for a, b in near}


def test_short_lines_go_as_exact_copies(spark):
    import corpus_pipeline

    texts = ["Home\nAbout\n\n \t\none line that is long enough", "Home\nabout\n\n \t\none line that is long enougk", "Home\nHome"]
    kept = corpus_pipeline.line_dedup(spark, documents(spark, texts), SMALL).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {0: texts[0], 1: "about\n\n \t", 2: ""}


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_within_edits(spark, k):
    pairs = [("kitten", "sitting"), ("abc", "abc"), ("abcdef", "bcdefg"), ("", "ab"), ("abc", ""), ("aéx", "aex"), ("𝒳ab", "ab")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    rows = rows.withColumns({x: line_dedup.letters_of(F.col(x[0])) for x in ("aa", "bb")}).cache()
    near = rows.select("a", "b", line_dedup.within_edits(F.col("aa"), F.col("bb"), k).alias("near")).collect()
    assert all(row["near"] == (edits(row["a"], row["b"]) <= k) for row in near)


def test_secret_scan(spark):
    key = "AKIA" + "A1" * 8
    texts = [
        f"é password = 'abcdefghijkl' {key} 0123456789abcdef",
        "secret=password: abcdefghijklmno",  # the leftmost match fails and takes its place
        "TOKEN:short",
        "-----BEGIN RSA PRIVATE KEY-----",
        None,
        f"é password = 'abcdefghijkl' {key} 0123456789abcdef",
    ]
    findings, ledger = secret_scan.scan_history(documents(spark, texts), "1")
    rows = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["findings"]] for r in findings.collect()}
    assert rows[0] == [("assign", 2, 26), ("access", 28, 48), ("hex", 49, 65)] == rows[5]
    assert rows[1] == rows[2] == rows[4] == [] and rows[3] == [("pem", 0, 31)]
    ledger = ledger.cache()
    assert ledger.count() == 5  # copies are scanned once
    again, fresh = secret_scan.scan_history(documents(spark, [*texts, "api_key: 'aaaaaaaaaaaaaaaa'"]), "1", ledger)
    assert fresh.count() == 1
    assert {r["doc_id"]: len(r["findings"]) for r in again.collect()} == {0: 3, 1: 0, 2: 0, 3: 1, 4: 0, 5: 3, 6: 2}
    assert secret_scan.scan_history(documents(spark, texts), "2", ledger)[1].count() == 5  # new rules, new scan


def test_secret_scan_shuffles_texts_once(spark, monkeypatch):
    """Contents are dealt out once, where the ledger's blobs meet them."""
    scans, written = [], secret_scan.written
    monkeypatch.setattr(secret_scan, "written", lambda df: scans.append(df) or written(df))
    texts = ["token = abcdefghijkl", "nothing", "token = abcdefghijkl", None]
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the ledger were large
    try:
        _, ledger = secret_scan.scan_history(documents(spark, texts[:2]), "1")
        findings, fresh = secret_scan.scan_history(documents(spark, [*texts, "secret: 0123456789ab"]), "1", ledger)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in scans]
        assert {r["doc_id"]: len(r["findings"]) for r in findings.collect()} == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert fresh.count() == 2  # the empty blob and the new one
    assert [plan.count("Exchange hashpartitioning") for plan in plans] == [1, 2]  # the texts; them and the ledger's blobs


def test_quality(spark):
    def brute(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        again = sum(line in lines[:n] for n, line in enumerate(lines))
        symbols = sum(c in "#*$%&|<>" for c in text)
        return len(words), sum(map(len, words)), symbols, again, len(covered)

    texts = ["", "a b c a b c", "x\x85y z\xa0w\n\nx\x85y z\xa0w", "# * | $\n" * 3, "a b " * 40]
    texts += [row["text"] for row in given(spark).collect()][:60]
    for row in quality.clean_lines(documents(spark, texts)).collect():
        text = texts[row["doc_id"]]
        assert tuple(row[1:6]) == brute(text)
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
    body = "\n".join(f"Line{n} has{n} words{n} of{n} its{n} own{n}." for n in range(20))
    noisy = body + "\nHome | About | Contact\nWe use cookies, see our cookie policy.\nhome"
    row = quality.clean_lines(documents(spark, [noisy])).first()
    assert row["kept"] and row["n_failed_lines"] == 3 and row["clean_text"] == body


def test_toxicity_on_held_out(spark):
    scored = queries.toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == x] for x in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.75  # of 300 labels; 0.99 on larger tables
    texts = ["You are nice. The day is fine."] * 8 + ["The day is fine. You are a scumbag. It rains."] * 8
    texts = [f"{text} Word{n} more." for n, text in enumerate(texts)]
    model = toxicity.fit(texts, [0] * 8 + [1] * 8, {0: 1.0, 1: 1.0}, toxicity.Training())
    located = model.locate("The day is fine. You scumbag. Fine.")
    assert [(s["start"], s["end"]) for s in located] == [(16, 28)]
    assert model.score("") == 0


ITEM = "A train travels 300 km in five hours from Berlin to the coast. How fast did the train from Berlin travel on average?"


def test_decontamination(spark):
    changed = ITEM.replace("300", "420").replace("five", "seven").replace("Berlin", "Madrid").replace("km", "miles")
    mixed = changed.replace("from Madrid to", "from Lisbon to")  # one slot with two values
    texts = [f"Before it. {ITEM} After it.", f"Other text {changed}", mixed, "No such text here at all.", None, ""]
    bench = spark.createDataFrame([(7, ITEM), (8, "Something else entirely that no document has in any form")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontamination.leaks(documents(spark, texts), bench).collect()}
    assert found == {(0, 7): False, (1, 7): True}
    assert {r["doc_id"] for r in decontamination.drop_contaminated(documents(spark, texts), bench).collect()} == {2, 3, 4, 5}


def test_decontamination_whatever_the_case(spark):
    short = "Which river flows through the old town"  # one window, shorter than eight
    german = "Der Zug nach Hamburg braucht am Abend vier Stunden und hält im Bahnhof von Hannover und Bremen an"
    texts = [f"So. {ITEM.upper()}", f"So {german.lower()} und", f"Q: {short}", "No such text here at all."]
    bench = spark.createDataFrame([(7, ITEM), (8, german), (9, short)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(documents(spark, texts), bench).collect()}
    assert found == {(0, 7), (1, 8), (2, 9)}


def test_decontamination_with_a_typo_or_many_slots(spark):
    long = ITEM + " The driver of the train says that it never stops before it comes to the coast from Berlin in the morning."
    heavy = "In 12 34 56 Paris Rome 78 Oslo 90 Bern 21 43 65 Lima Cairo 87 Kiev"
    typo = long.replace("from Berlin travel", "from Berlni travel")
    texts = [f"So. {typo}", long.replace("Berlin", "Madrid", 1).replace("Berlin", "Lisbon"), f"So. {heavy}", "In 12 34 56 Paris"]
    bench = spark.createDataFrame([(7, long), (8, heavy)], "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(documents(spark, texts), bench).collect()}
    assert {(0, 7), (2, 8)} <= rows.keys() and not rows.keys() & {(3, 7), (3, 8)}
    assert rows[0, 7]["coverage"] > 0.7 and rows[2, 8]["coverage"] == 1 and not rows[2, 8]["reparameterised"]


def test_substring_dedup(spark):
    passage = " ".join(f"This is sentence number {n} of a passage which repeats." for n in range(8))
    texts = [f"First alone. {passage} Ends here.", f"Quite other words come first.\n{passage.upper()}\nAnd others last.", "Nothing here. Is repeated."]
    rows = substring_dedup.repeated_spans(documents(spark, texts)).collect()
    assert [(r["doc_id"], r["copied_from"]) for r in rows] == [(1, [0])]
    left = {r["doc_id"]: r["text"] for r in substring_dedup.drop_repeats(documents(spark, texts)).collect()}
    assert left[0] == texts[0] and left[2] == texts[2]
    assert "PASSAGE" not in left[1] and "And others last." in left[1] and "Quite other" in left[1]
    # every span by brute force
    spans = {}
    for i, text in enumerate(texts):
        parts = substring_dedup.sentence_parts(text, 20)
        for a in range(len(parts)):
            b = next((b for b in range(a + 2, len(parts) + 1) if sum(p[3] for p in parts[a:b]) >= 30), None)
            if b:
                spans.setdefault(tuple(p[2] for p in parts[a:b]), []).append((i, parts[a][0], parts[b - 1][1]))
    gone = sorted((p[1], p[2]) for places in spans.values() for p in sorted(places)[1:])
    assert [(s["start"], s["end"]) for s in rows[0]["spans"]] == gone


@pytest.mark.parametrize("share", [1.0, 0.0])
def test_sentence_spans_equal_brute_force(spark, monkeypatch, share):
    """Texts too short for a window of words: every run of sentences by its own characters. All spans hot, or none."""
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)
    monkeypatch.setattr(substring_dedup, "SAMPLED", 1)
    settings = substring_dedup.Spans(sentences=2, words=6)
    rng = random.Random(7)
    kinds = [" ".join(rng.choice("ab cd EF gh ij".split()) for _ in range(rng.randint(1, 6))) + rng.choice(".!?") for _ in range(9)]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(kinds) for _ in range(rng.randint(0, 8))) for _ in range(60)]
    first, want = {}, {}
    for doc_id, text in enumerate(texts):
        parts = [m for m in re.finditer(r"[^.!?\n]+[.!?]*", text) if m[0].split()]
        words = [m[0].lower().split() for m in parts]
        assert sum(map(len, words)) < 50
        for a in range(len(parts)):
            ends = [b for b in range(a + 2, len(parts) + 1) if sum(map(len, words[a:b])) >= 6]
            if ends:
                place = (doc_id, parts[a].start())
                if first.setdefault(str(words[a : ends[0]]), place) != place:
                    want.setdefault(doc_id, set()).add((parts[a].start(), parts[ends[0] - 1].end()))
    got = substring_dedup.repeated_spans(documents(spark, texts), settings).collect()
    assert {r["doc_id"]: {tuple(x) for x in r["spans"]} for r in got} == want


def test_substring_dedup_catches_passages_in_mid_sentence(spark):
    def words(kind, n):
        return " ".join(f"{kind}{i * 7919 % 1009}" for i in range(n))

    bare = words("bare", 200)
    parted = re.sub(r"(w19|w38|w57)\b", r"\1.", " ".join(f"w{i}" for i in range(10, 61)))  # 51 words, one whole sentence of 19
    texts = [f"{words('a', 5)} {bare} {words('b', 9)}", f"{words('c', 7)} {bare.upper()} {words('d', 4)}", "word " * 300]
    texts += [f"{words('e', 9)} {parted} {words('f', 15)}", f"{words('g', 6)} {parted} {words('h', 12)}"]
    rows = {r["doc_id"]: r for r in substring_dedup.repeated_spans(documents(spark, texts)).collect()}
    assert rows[1]["copied_from"] == [0] and rows[4]["copied_from"] == [3] and rows[2]["copied_from"] == [2]
    assert 0 not in rows and 3 not in rows
    left = {r["doc_id"]: r["text"].split() for r in substring_dedup.drop_repeats(documents(spark, texts)).collect()}
    assert left[0] == texts[0].split() and 0 < len(left[2]) < 60
    assert len([w for w in left[1] if w.startswith("BARE")]) <= 2 * 20 and left[1][:7] == words("c", 7).split()
    assert len([w for w in left[4] if w.startswith("w")]) <= 21
    # every place and length from 50 words on
    windows = substring_dedup.Windows(substring_dedup.Spans())
    for n in range(20):
        whole = {" ".join(bare.split()[at : at + 30]) for at in windows.chosen(bare.split())}
        part = [f"x{i}" for i in range(n)] + bare.split()[n * 7 : n * 7 + 50] + ["y"] * n
        assert whole & {" ".join(part[at : at + 30]) for at in windows.chosen(part)}


def wrapped(text, width=60):
    return "\n".join(textwrap.wrap(text, width))


def license_texts():
    whole = {name: text for name, titles, text in licenses.TEXTS if titles}
    return [
        f"Copyright 2020 X\n{whole['MIT'].upper().replace('LICENSE', 'LICENCE')}",
        "words\nLicenced under CC-BY-NC 4.0\nmore",
        "none",
        f"The MIT License (MIT)\n\nCopyright (c) 2024 Someone\n\n{wrapped(whole['MIT'])}\n",
        f"# My project\n\nSome words.\n\n## License\n\nCopyright (c) 2024 Someone\n\n{wrapped(whole['MIT'])}\n\nThe end.",
        f"ISC License\n\n{wrapped(whole['ISC'], 40)}",
        wrapped(whole["BSD-3-Clause"]).replace("* ", "- "),
        f"{whole['ISC']} More.",
        "\n".join([wrapped(whole["Zlib"])] * 2),
        wrapped(whole["MIT"]).replace("IN NO EVENT", "IN ANY EVENT"),
        "This\n" * 200,
    ]


def test_licenses(spark):
    rows = {r["doc_id"]: r for r in licenses.find_licenses(documents(spark, license_texts())).collect()}
    assert {n: r["whole_license"] for n, r in rows.items()} == {
        0: "MIT", 1: None, 3: "MIT", 4: None, 5: "ISC", 6: "BSD-3-Clause", 8: None,
    }
    assert rows[1]["licenses"] == "CC-BY-NC-4.0" and rows[1]["license_lines"] == 1 and 2 not in rows
    assert (rows[4]["licenses"], rows[4]["license_runs"]) == ("MIT", 1)
    assert (rows[8]["licenses"], rows[8]["license_runs"]) == ("Zlib", 2)


def test_license_sql(spark, tmp_path):
    sf, sql = "/root/testdata/sf0.01", queries.oracle_sql()["op9_license_scan"]
    assert difference(queries.license_scan(spark, sf), duck(sf), sql) is None
    documents(spark, license_texts()).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(queries.license_scan(spark, str(tmp_path)), connection, sql) is None


def test_url_filter(spark):
    urls = ["HTTP://WWW.Example.COM/en/1?q#f", "http://a.net/fr/2", "http://com/x", "http://xcom/x", "no url", None, "http://a.com"]
    rows = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), queries.URL_RULES).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1] == ("a.net", "/fr/2", "net/fr/", "block") and got[2][2] == "com/"
    assert got[3][2] is None and got[4][:3] == ("", "", None) == got[5][:3] and got[6][2] is None


def test_url_tree_generalises_and_rejects(spark):
    rules = [*queries.URL_RULES, queries.Rule("h.org/spam/x", "block"), queries.Rule("h.org/good/a", "allow")]
    paths = [f"/spam/{'x' if n % 2 else 'y'}{'abcdefghijklmnopqrstuvwxyz'[n % 26]}q{'mnopqrst'[n % 8]}" for n in range(100)]
    paths += [f"/good/a{n}" for n in range(20)]
    pages = spark.createDataFrame([(n, f"http://h.org{p}") for n, p in enumerate(paths)], "page_id long, url string")
    rows = {r["page_id"]: r for r in judge_urls(pages, rules).collect()}
    assert rows[0]["rule"] is None and rows[0]["template"] == "/spam/*" and rows[0]["verdict"] == "block"
    assert rows[100]["template"] == "/good/a<n>" and rows[100]["verdict"] == "allow"


def test_url_tree_decides_on_evidence_only(spark):
    rules = [queries.Rule(f"{prefix}/", "block") for prefix in ("hot.org/a", "mix.org/fr", "mix.org/es", "other.org/en")]
    urls = [f"http://hot.org/a/{n}" for n in range(300)]  # the overall blocked share is 1
    urls += [f"http://clean.org/x/{n}" for n in range(30)]
    sizes = (("fr", 40), ("es", 41), ("en", 38), ("it", 40), ("big", 400))
    urls += [f"http://mix.org/{lang}/page{n}" for lang, pages in sizes for n in range(pages)]
    urls += [f"http://other.org/en/page{n}" for n in range(20)]
    rows = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    got = {(r["host"], r["path"].split("/")[1]): (r["template"], r["verdict"]) for r in rows}
    assert got["clean.org", "x"] == ("/x/<n>", "allow")
    assert got["mix.org", "fr"] == got["mix.org", "es"] == got["mix.org", "en"] == ("/*/page<n>", "block")
    assert got["mix.org", "it"] == ("/it/page<n>", "allow")  # as many pages and paths, but no label anywhere
    assert got["mix.org", "big"] == ("/big/page<n>", "allow")


def test_url_rules_of_equal_length_go_by_order(spark):
    pages = spark.createDataFrame([(1, "http://a.com/ab")], "page_id long, url string")
    rules = [queries.Rule("a.com/", "block"), queries.Rule("com/ab", "allow")]
    for order in (rules, rules[::-1]):
        assert judge_urls(pages, order).first()["rule"] == order[0].prefix


def test_own_columns_of_documents_never_clash(spark):
    """Columns under any name that a stage might use for itself."""
    names = ["id", "id_", "__id", "spans", "__spans", "repeated", "Repeated_", "line", "at", "key"]
    line = "The same line of words stands in both of these documents here. And another sentence follows it with some words more. " * 2
    rows = [(n, line, *(f"{name}{n}" for name in names)) for n in range(2)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    for stage in (substring_dedup.drop_repeats, line_dedup.drop_repeated_lines):
        kept = {r["doc_id"]: r for r in stage(docs).collect()}
        assert stage(docs).columns == docs.columns
        assert kept[0]["text"].strip() and not kept[1]["text"].strip()
        assert [kept[1][name] for name in names] == [f"{name}1" for name in names]


MESSY = [(1, "Some text here. " * 30, "en"), (1, "Some text here. " * 30, "en"), (2, None, None), (None, "x " * 60, "fr"), (3, "", "en"), (4, "word " * 200_000, "de"), (None, None, None)]


@pytest.mark.parametrize("empty", [False, True])
def test_nulls_ties_long_texts_and_clashing_columns(spark, empty):
    """Every operator and stage runs on odd tables, and rows of the per-row ones match the table's."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([] if empty else MESSY, schema)
    for name in ("key", "score", "blob", "span", "line", "fp", "host", "first", "hash"):
        docs = docs.withColumn(name, F.lit(1))
    labels = spark.createDataFrame([] if empty else [(1, None), (None, 1), (4, 0), (1, 1)], "doc_id long, toxic int")
    bench = spark.createDataFrame([] if empty else [(1, None), (None, "a b c d e f g h"), (2, ""), (3, "some text here some text here some text")], "item_id long, text string")
    pages = docs.withColumns({"page_id": F.col("doc_id"), "url": F.col("text")})
    n = 0 if empty else len(MESSY)
    assert bpe_encode(docs, VOCABULARY, public_tokenizers.PATTERN).count() == n
    assert quality.clean_lines(docs).count() == n
    assert toxicity.score_toxicity(docs, labels).count() == n
    assert secret_scan.scan_history(docs, "1")[0].count() == n
    assert simhash_components(docs).count() == n
    assert judge_urls(pages, queries.URL_RULES).count() == n
    assert line_dedup.drop_repeated_lines(docs).count() == n
    assert substring_dedup.drop_repeats(docs).count() == n
    licenses.find_licenses(docs).count()
    decontamination.leaks(docs, bench).count()
    docs = toxicity.drop_toxic(docs, labels)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "key", "score", "blob", "span", "line", "fp", "host", "first", "hash"]
    decontamination.drop_contaminated(docs, bench).count()


def test_pipeline_keeps_columns_and_decides(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns
        assert docs.count() <= before and (name == "line_dedup" or docs.count() < before or name == "decontamination")
        before = docs.count()
    assert corpus_pipeline.run(spark, SMALL).count() == before
    assert {*entry.queries()} >= {*queries.queries(), "pipeline"}
