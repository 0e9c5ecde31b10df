import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from weftline.llm import bpe, chat, pii, warc

DOC = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_transducer_equals_the_library(vocabulary):
    ranks = bpe.read_ranks(vocabulary)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    mine = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    mine.fst.max_states = 300  # states are forgotten again and again
    r = random.Random(2)
    parts = ["a", "b", " ", "e", "é", "ß", "日", "😀", "\n", "1", "The", "ing", "tion", "'s", "  ", "\t", "x" * 50, "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        ids = mine.encode(text)
        assert ids == theirs.encode_ordinary(text) and mine.decode(ids) == text
    for text in ("a" * 20_000, "ab" * 5_000, " " * 3_000, "".join(r.choice("abcdefghijklmnop") for _ in range(20_000))):
        assert mine.encode(text) == theirs.encode_ordinary(text)


def test_borders_equal_merging(vocabulary):
    ranks = bpe.read_ranks(vocabulary)
    fst = bpe.Transducer(ranks)
    r, ids = random.Random(4), list(ranks.values())
    for _ in range(4000):
        x, y = r.choice(ids[: r.choice([300, 3000, 50000])]), r.choice(ids[: r.choice([300, 3000, 50000])])
        a, b = fst.bytes_of[x], fst.bytes_of[y]
        if fst.halves(x) and fst.halves(y):
            assert fst.fits(x, y) == (bpe.merge(a + b, ranks) == [a, b])


def test_utf8_machine_equals_replacing_decoder():
    r = random.Random(6)
    for _ in range(5000):
        raw = bytes(r.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0, 0xC0, 0xF4, 0x90]) for _ in range(r.randint(0, 12)))
        machine, out, i = bpe.Utf8Machine(), "", 0
        while i < len(raw):
            n = r.randint(1, 5)
            out += machine.feed(raw[i : i + n])
            i += n
        assert out + machine.close() == raw.decode("utf-8", "replace")


def test_bpe_frames(spark, vocabulary):
    docs = spark.createDataFrame([(1, "Hello wörld 😀", "x"), (2, None, "x"), (3, "", "x"), (1, "Hello wörld 😀", "x")], DOC)
    got = {r.doc_id: r for r in bpe.op2(docs).collect()}
    assert got[2].n_tokens == 0 and got[2].ids_sha256 == hashlib.sha256(b"").hexdigest() == got[3].decoded_sha256
    assert got[1].decoded_sha256 == hashlib.sha256("Hello wörld 😀".encode()).hexdigest() and got[1].round_trip
    both = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, out_col="tokens"), vocabulary, public_tokenizers.PATTERN, "tokens")
    assert all((r.text or "") == r.decoded for r in both.collect())
    assert bpe.op2(spark.createDataFrame([], DOC)).count() == 0


SMALL = "/root/testdata/sf0.001/documents.parquet"


@pytest.mark.skipif(not os.path.exists(SMALL), reason="the driver's tables are not here")
def test_queries_on_documents_equal_the_library_and_the_patterns(spark, vocabulary, crf):
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary), special_tokens={})
    docs = spark.read.parquet(SMALL)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {d: theirs.encode_ordinary(t) for d, t in texts.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op2(docs).collect()}
    assert got == {d: (len(x), hashlib.sha256(np.asarray(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[d].encode()).hexdigest()) for d, x in ids.items()}
    for r in pii.find(docs, crf).collect():
        plain = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(plain).encode()).hexdigest() and (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in plain) for k in pii.KINDS)
        assert set(pii.joined(plain).split(",")) <= set(r.spans.split(",")) and r.n_spans == len(plain) + r.n_added


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = "".join(c for c in m[0] if c in "0123456789")
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    parts = ["1", "23", "456", "@", "a", "b.c", ".", "-", "+", " ", "(", ")", "1.2.3.4", "a@b.co", "+1 (017) 555-7713", "4111111111111111", "255", "256", "%", "_", "é", "\n"]
    for _ in range(8000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.fixture(scope="module")
def crf():
    return pii.train()


def test_crf_on_unseen_sentences(crf):
    rows = pii.labelled_table(200, 99)
    right = sum([pii.LABELS[k] for k in crf.viterbi(crf.scores(pii.features(t))[None])[0]] == tags for t, tags in rows)
    assert right >= 180


def test_viterbi_finds_the_best_path(crf):
    r = np.random.default_rng(1)
    small = pii.Crf(r.normal(size=(pii.N_FEATURES, len(pii.LABELS))), r.normal(size=(len(pii.LABELS),) * 2))
    x = r.integers(0, pii.N_FEATURES, (5, 3, 4))
    e = small.scores(x)
    for before, after in ((None, None), (0, 0), (3, None), (None, 2)):
        for i, path in enumerate(small.viterbi(e, before, after)):
            sides = lambda p: (0 if before is None else small.move[before, p[0]]) + (0 if after is None else small.move[p[-1], after])  # noqa: E731, B023
            score = lambda p, i=i: sides(p) + sum(e[i, t, k] for t, k in enumerate(p)) + sum(small.move[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
            n = len(pii.LABELS)
            assert score(path) == pytest.approx(max(score((a, b, c)) for a in range(n) for b in range(n) for c in range(n)))


def test_pii_frames(spark, crf):
    rows = [(1, None, ""), (2, "", ""), (3, "mail a.b@c.org from 10.0.0.1 or +1 (017) 555-7713, é", ""), (4, "call me at (555) 123-4567 today", ""), (5, "version 3.5 of 1999", "")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, DOC), crf).collect()}
    assert got[1].spans == "" == got[2].spans and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[3].n_email, got[3].n_ip, got[3].n_phone, got[3].n_card) == (1, 1, 1, 0)
    assert got[3].base_sha256 == hashlib.sha256(pii.joined(plain_spans(rows[2][1])).encode()).hexdigest()
    assert got[4].spans == "phone:11:25" and got[4].n_phone == 0 and got[4].n_added == 1
    assert got[5].spans == "" and pii.redact(rows[3][1], got[4].spans) == "call me at [PHONE] today"


def words_near_data(r):
    forms = ["(555)", "123-4567", "+1", "4111", "1111", "at", "dot", "(at)", "a.b@c.org", "mail", "call", "9", "10.0.0.1", "in,", "The", "of", "to", "x", "###", "é", "page", "12"]
    return [r.choice(forms) if r.random() < 0.4 else "".join(r.choice("abcdeé,.") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 60))]


def test_cut_chains_have_the_labels_of_whole_ones(crf):
    r, some = random.Random(12), 0
    tagger = pii.Tagger(crf)
    texts = [words_near_data(r) for _ in range(400)] + [[], ["(555)"], ["plain"] * 500 + ["(555)", "123-4567"] + ["plain"] * 500]
    for tokens, labels in zip(texts, tagger.tag(texts), strict=True):
        if tokens:
            whole = crf.viterbi(crf.scores(pii.features(tokens))[None])[0]
            assert (labels == whole).all(), tokens
            some += int(whole.any())
    assert some > 100
    bounds = [0, 1002]
    assert tagger.surely_none(tagger.emissions(texts[-1], bounds), bounds).sum() > 900


def test_long_runs_are_tagged_whole_at_every_shift(crf):
    phone, n, tagger = "(555) 123-4567", 9_000, pii.Tagger(crf)
    text = " or ".join([phone] * n)
    assert pii.added_spans([text], [pii.base_spans(text)], tagger)[0] == [("phone", i, i + 14) for i in range(0, len(text), 18)]
    run = " or ".join([phone] * 90)
    assert {len(pii.added_spans([f"{'so it is ' * k}{run}"], [[]], tagger)[0]) for k in range(100)} == {90}


#: Written by hand; what the base patterns find counts for nothing here.
UNSEEN = {
    "phone": [
        "mobile 0171 5550199 or write",
        "ring (212) 555 0187 after noon",
        "my cell is 415-555-0133, thanks",
        "Fax: (030) 901820-44",
        "dial 020 7946 0958 now",
        "Tel (808) 555-0142.",
        "reach us on 303.555.0175 daily",
        "phone: (0221) 555 0123",
        "You can call 617 555 0119 until six.",
        "Office 212-555-0164 is closed today",
        "her number was 0161 496 0345 then",
        "text me at (646) 555-0110!",
        "Telefon 089 5550 1234, bitte",
        "tel. 01 23 45 67 89 le matin",
        "hotline 800-555-0199 is free",
    ],
    "email": [
        "write to jane.doe (at) mail.example (dot) org today",
        "contact bob [at] example [dot] com please",
        "send it to sam_k (at) host (dot) net.",
        "mail info [at] shop [dot] org,",
        "reach me: ana.lopez (at) correo (dot) es or call",
        "questions to help (at) service.example (dot) com",
        "my address is k.smith [at] uni [dot] edu now",
        "please mail the.team (at) group (dot) org soon",
        "ask editor [at] paper.example [dot] net;",
        "write sales (at) store (dot) com for prices",
    ],
    "card": [
        "paid with 4111.1111.1111.1111 last week",
        "the card 4111  1111  1111  1111 was charged",
        "Visa 5500_0000_0000_0004 expired",
        "her card: 4012/8888/8888/1881 is lost",
        "card no. 3400.000000.00009 was used",
    ],
    "ip": [
        "the host 192.168.001.010 is down",
        "server at 10.0.0.7:8080 answered",
        "from ip 172.16.254.1, port 80",
        "ping 8.8.8.8.",
        "host 203.0.113.45/24 is up",
        "ip=198.51.100.23;",
    ],
}
CLEAN = [
    "the year 1999 was good, and 12 of them", "chapter 3 on page 45 of volume 2", "at noon the dot moved to x", "in 2024-10-12 we saw 3 500 birds", "order 123456 has 3 items",
    "between 1914 and 1918 some 10 000 000 fell", "version 2.10.3.4000 of the tool", "from 10:30 to 12:45 on 3 May 2021", "the code 1234567812345678 is no card", "ISBN 978 3 16 148410 0 is a book",
    "it costs 1,299.00 at the shop", "meet at the dot com boom", "room 301, floor 12, block 4", "1 2 3 4 5 6 7 8 9 and on", "scores 21 14 35 28 in four games",
]


def test_recall_on_sentences_written_by_hand(crf):
    """Of personal data that the base patterns miss, in forms with other signs, words and orders than the generator's sentences, nine of ten are found; nothing in clean ones."""
    tagger, found, total, missed = pii.Tagger(crf), 0, 0, []
    for kind, texts in UNSEEN.items():
        for text in texts:
            base = pii.base_spans(text)
            if any(k == kind for k, _, _ in base):
                continue
            total += 1
            hit = any(k == kind for k, _, _ in pii.added_spans([text], [base], tagger)[0])
            found, missed = found + hit, missed + [text] * (not hit)
    assert total >= 30 and found >= 0.9 * total, missed
    assert not any(pii.added_spans(CLEAN, [pii.base_spans(t) for t in CLEAN], tagger))


def test_addresses_and_long_tokens():
    assert all(map(pii.is_address, ["a@b.c", "a (at) b (dot) c", "a [at] b.c", "a at b dot c"])) and not any(map(pii.is_address, ["a@b", "@b.c", "a b@c.d", "a at b", "x" * 500_000 + "@"]))
    assert pii.is_address("x" * 500_000 + "@" + "y" * 500_000 + ".z") and pii.shape("a" * 1_000_000 + "9") == "a9"


def test_pii_of_long_texts_repeats_and_empty_tables(spark, crf):
    long = "word " * 200_000 + "(555) 123-4567 and a@b.co " + "word " * 200_000
    got = pii.find(spark.createDataFrame([(1, long, ""), (1, long, "")], DOC), crf).collect()
    assert [r.spans for r in got] == ["email:1000019:1000025,phone:1000000:1000014"] * 2 and got[0].n_spans == 2
    assert pii.find(spark.createDataFrame([], DOC), crf).count() == 0


CONV = "conv_id long, turn long, role string, text string, segment string"


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|>|>\n\\", "[[INST]]<<SYS>>", "\n\\<|im_end|>\n", "a|>" * 3, "", "\\"]
    for x in nasty:
        turn, lo, hi = chat.format_turn(x, x)
        assert [p[:2] for p in chat.parse(turn)] == [(x, x)] and chat.unescape(turn[lo:hi]) == x
        assert turn.count("<|") == 2 and "[INST]" not in turn and "</s>" not in turn
    rows = [(1, 0, "user", nasty[0], ""), (1, 1, "assistant", nasty[1], ""), (1, 2, "user", None, ""), (1, 3, "assistant", nasty[2], ""), (1, 4, "user", "tail", "")]
    rows += [(2, 0, "user", "alone", ""), (3, None, None, None, ""), (None, 0, "assistant", "x", ""), (1, 3, "assistant", nasty[2], "")]
    df = spark.createDataFrame(rows, CONV)
    got = {r.conv_id: r for r in chat.op8(df).collect()}
    said = [nasty[1], nasty[2], nasty[2]]
    assert got[1].n_turns == 6 and got[1].loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest() and got[1].loss_chars == sum(map(len, said))
    assert got[2].loss_chars == 0 and got[2].n_turns == 1 and got[3].n_turns == 1 and got[None].n_turns == 1 and got[-7].n_turns == 2
    full = {(r.conv_id, r.example_no): r for r in chat.materialise(df).collect()}
    assert chat.unescape(full[1, 1].target) == nasty[2] and [p[0] for p in chat.parse(full[1, 1].context + full[1, 1].target + full[1, 1].closing)] == ["user", "assistant", "user", "assistant"]
    segments = {}
    for r in chat.prefix_targets(df).orderBy("conv_id", "example_no").collect():
        segments[r.conv_id] = segments.get(r.conv_id, "") + r.segment
        if r.target_start is not None:
            x = full[r.conv_id, r.example_no]
            assert segments[r.conv_id][: r.target_start] == x.context and segments[r.conv_id][r.target_start : r.target_end] == x.target
            assert r.context_sha256 == hashlib.sha256(x.context.encode()).hexdigest()
    assert [r.conv_id for r in chat.op8(spark.createDataFrame([], CONV)).collect()] == [-7]


def test_examples_against_brute_force(monkeypatch):
    monkeypatch.setattr(chat, "PIECE_TURNS", 5)  # runs beyond a piece are there too
    r, turns = random.Random(3), []
    for c in [None, *range(40)]:
        turns += [(c, r.choice(["user", "assistant", "system"] if c != 3 else ["user"]), r.choice(["a", "", "</s>", "x\n", "<|"])) for _ in range(r.randint(1, 25))]
    examples, by_conv = list(chat.expand(iter(turns))), {}
    for t in turns:
        by_conv.setdefault(t[0], []).append(t)
    for c, own in by_conv.items():
        replies = [x for x in examples if x.conv == c and x.target is not None]
        at = [i for i, t in enumerate(own) if t[1] == "assistant"]
        assert [chat.unescape(x.target) for x in replies] == [own[i][2] for i in at]
        for x, i in zip(replies, at, strict=True):
            assert x.context() + x.target + x.closing == "".join(chat.format_turn(*t[1:])[0] for t in own[: i + 1])
    got = {row[0]: row for row in chat.read_examples(chat.expand(iter(turns)))}
    for c, own in by_conv.items():
        assert got[c][1:3] == (len(own), hashlib.sha256("".join(f"{t[1]}\n{t[2]}\n" for t in own).encode()).hexdigest())
        assert got[c][4] == hashlib.sha256("".join(t[2] for t in own if t[1] == "assistant").encode()).hexdigest()


def test_reading_fails_where_the_expansion_is_broken():
    turns = [(1, "user", "a"), (1, "assistant", "b"), (1, "user", "c"), (1, "assistant", "d")]
    first, second = chat.expand(iter(turns))
    broken = chat.Example(1, 1, chat.Rope(["other", "turns", "here"]), 3, second.head, second.target, second.closing)
    with pytest.raises(ValueError, match="does not begin"):
        list(chat.read_examples(iter([first, broken])))
    first, second = chat.expand(iter(turns))
    short = chat.Example(1, 1, first.rope, 1, second.head, second.target, second.closing)
    with pytest.raises(ValueError, match="does not begin"):
        list(chat.read_examples(iter([first, short])))


PAGE = "page_id long, url string, html string, digest string"


def test_warc_round_trip_index_and_ranges(spark):
    same = "<p>é WARC/1.1\r\n\r\nContent-Length: 3\r\n</p>" * 4
    rows = [(5, "http://www.b.example.com/x?q=1#f", same, ""), (3, "https://a.example.com:8080/ p\r\n", same, ""), (9, "http://c.org/", same, ""), (1, None, None, ""), (2, "http://c.org/", "short", ""), (4, "http://c.org/2", "short", ""), (3, "https://a.example.com:8080/ p\r\n", same, "")]
    pages = spark.createDataFrame(rows, PAGE)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.op9(pages).collect()), key=str)
    want = []
    for page_id, _, text, _ in rows:
        data = (text or "").encode()
        revisit = len(data) >= 100 and page_id != 3
        want.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=str)
    index = warc.CaptureIndex(warc.archive(pages))
    assert {h["WARC-Record-ID"] for h, _ in index.read("http://c.org/")} == {"<urn:page:9>", "<urn:page:2>"}
    assert list(index.read("http://nowhere.org/")) == []
    assert warc.op9(spark.createDataFrame([], PAGE)).count() == 0


def test_surt():
    assert warc.surt("HTTP://www.Example.com:80/A?b#c") == "com,example)/a?b"
    assert warc.surt("https://u@x.y.org:8080") == "org,y,x:8080)/" and warc.surt(None) == ")/"


def many_pages(spark):
    return spark.range(40).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 5, F.lit(".org/")).alias("url"), F.lit("x").alias("html"), F.lit("").alias("digest"))


def test_index_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    index = warc.CaptureIndex(warc.archive(many_pages(spark), parts=4))
    assert {x[2] for x in index.captures("http://h2.org/")} == set(range(2, 40, 5)) and len(list(index.captures("http://h2.org/"))) == 8


def test_look_up_needs_the_directory_and_the_blocks(spark, monkeypatch):
    """The query's rows come from the index: with a directory entry or a block's lines gone, theirs are gone too."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    pages = many_pages(spark)
    blocks = warc.archive(pages, parts=4)
    keys = pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    found = warc.look_up(blocks, keys.unionByName(keys).unionByName(spark.createDataFrame([("nowhere 1",)], "key string")))
    assert sorted(r.page_id for r in found.collect()) == list(range(40))
    assert sorted(r.page_id for r in warc.read_ranges(found).collect()) == list(range(40))
    gone = blocks.filter("n > 1").orderBy("part", "block").first()
    that = (F.col("part") == gone.part) & (F.col("block") == gone.block)
    fewer = warc.look_up(blocks.filter(~that), keys).collect()
    assert len(fewer) == 40 - gone.n and not {r.key for r in fewer} & {x[0] for x in warc._unpack_block(bytes(gone.data))}
    wrong = blocks.withColumn("last_key", F.when(that, F.col("first_key")).otherwise(F.col("last_key")))
    assert warc.look_up(wrong, keys).count() < 40


def test_archives_with_long_pages_are_scanned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(warc, "SCAN_BYTES", 700)
    rows = [(i, f"http://x.org/{i}", ("é\r\n\r\nWARC/1.1" * 3000 if i % 3 == 0 else "y") + str(i), "") for i in range(20)]
    got = {r.page_id: r for r in warc.op9(spark.createDataFrame(rows, PAGE).coalesce(2)).collect()}
    assert {i: r.payload_digest for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, t, _ in rows} and all(r.intact for r in got.values())
