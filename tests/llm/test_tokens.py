"""Token files, packing and byte-pair encoding against the tokenizers library."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from care_analytics.llm import bpe, packing, token_files
from care_analytics.llm.common import new_folder
from care_analytics.llm.queries import tokenizer_path
from care_analytics.llm.units import UnitEncoder
from tests.llm.conftest import ODD

PATH = tokenizer_path()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def strange_texts():
    r = random.Random(5)
    chars = [chr(c) for c in itertools.chain(range(1, 0x600), range(0x1680, 0x1690), range(0x2000, 0x2070), [0x3000, 0x558, 0x88F, 0x10945, 0x1F600])]
    out = [f"a{c}b {c}c{c} d.{c}'s {c}{c}  e\n{c} \n 1{c}2 {c}" for c in chars]
    out += ["".join(r.choice("ab") for _ in range(60)) for _ in range(300)] + ["".join(r.choice("=-_*#/ ") for _ in range(60)) for _ in range(300)]
    return out + ["a" * 20_000, "ab" * 9000, " " * 3000, "<|endoftext|>", " a <|endoftext|> b<|endoftext|>c", "<|endof text|>", "I'll.'s don't"]


def test_both_encoders_match_the_library(library):
    texts = strange_texts()
    expected = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    prefix = bpe.PrefixEncoder(PATH)
    for coder in (UnitEncoder(PATH), prefix):
        ids, offsets = coder.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        assert [t for t, g, e in zip(texts, got, expected) if g != e] == []
    r = random.Random(1)
    lists = expected + [[r.randrange(50257) for _ in range(5)] for _ in range(300)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    decoded = prefix.decode(np.array(list(itertools.chain(*lists))), offsets)
    assert [d.decode() for d in decoded] == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_one_token_for_every_prefix():
    # merges of three letters, checked against merging by rank step by step
    coder = bpe.PrefixEncoder(PATH)

    def by_rank(text):
        parts = [t for t in (coder.piece(c)[0] for c in text)]
        while True:
            ranks = [(coder.rank.get(p, bpe.NEVER), i) for i, p in enumerate(zip(parts, parts[1:]))]
            best = min(ranks, default=(bpe.NEVER, 0))
            if best[0] == bpe.NEVER:
                return parts
            a, b = parts[best[1]:best[1] + 2]
            merged = next(t for t, (x, y, _) in coder.parts.items() if (x, y) == (a, b))
            parts[best[1]:best[1] + 2] = [merged]

    r = random.Random(2)
    for _ in range(60):
        word = "".join(r.choice("thean") for _ in range(r.randrange(1, 14)))
        assert coder.piece(word) == by_rank(word)


def test_round_trip_query(spark, docs, texts, odd, none, library):
    for frame, rows in ((docs, texts), (odd, ODD)):
        got = sorted(map(tuple, bpe.round_trip(frame, PATH).collect()), key=str)
        want = []
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == sorted(want, key=str)
    back = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in ODD), key=str)
    assert bpe.round_trip(none, PATH).count() == 0


def test_token_files(spark, docs, texts, odd, none, library):
    manifest = token_files.write_token_files(docs, PATH, new_folder(spark, "test-tokens"), length=64, shards=3)
    at, want, stream = 0, [], []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
        stream += ids
    assert sorted(map(tuple, token_files.read_token_files(manifest).collect())) == want
    shards = manifest.orderBy("shard").collect()
    assert sum(r["n_tokens"] for r in shards) == len(stream) and len(shards) == 3
    base = 0
    for r in shards:
        reader = token_files.ShardReader(r["path"])
        assert len(reader) == -(-r["n_tokens"] // 64)
        for row in (0, len(reader) // 2, len(reader) - 1):
            ids, mask = reader.ids(row), reader.mask(row)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata  # a view of the file
            assert ids[mask].tolist() == stream[base + row * 64:min(base + row * 64 + 64, base + r["n_tokens"])]
        base += r["n_tokens"]
    got = token_files.token_files_digest(spark, odd, PATH).collect()
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (len(x) + 1, crc(x + [0])) for x in (library.encode(t or "", add_special_tokens=False).ids for _, t in ODD))
    assert token_files.token_files_digest(spark, none, PATH).count() == 0


def check_packing(pieces, lengths, capacity):
    """Every id in one piece, sequences gapless from offset 0, no padding but below a power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    covered = sorted(sum(n for _, n, _ in x) for x in docs.values())
    assert covered == sorted(lengths)
    padding = 0
    for x in sequences.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


def test_packing(spark, docs, texts, odd, none, library):
    pieces = packing.pack(docs, PATH, capacity=256).collect()
    coded = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    assert check_packing(pieces, map(len, coded.values()), 256) == 0
    assert all(np.frombuffer(p["ids"], "<u4").tolist() == coded[p["doc_id"]][p["start"]:p["start"] + p["length"]] for p in pieces)
    odd_pieces = packing.pack_digest(odd, PATH).collect()
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD]
    assert sum(p["length"] for p in odd_pieces) == sum(sizes)
    assert packing.pack_digest(none, PATH).count() == 0


def test_closest_fill_is_the_best_subset():
    r = random.Random(3)
    for _ in range(150):
        counts = {s: r.randrange(1, 4) for s in r.sample(range(1, 30), r.randrange(1, 6))}
        room = r.randrange(1, 60)
        sums = {sum(s * k for s, k in zip(counts, ks)) for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
        chosen = packing.closest_fill(sorted(counts, reverse=True), counts, room)
        assert all(0 < k <= counts[s] for s, k in chosen.items())
        assert sum(s * k for s, k in chosen.items()) == max(x for x in sums if x <= room)


@pytest.mark.parametrize("histogram", [{}, {700: 1001}, {5: 3}, {1023: 4, 1: 2}, {600: 100, 424: 40, 3: 77}, {s: s % 7 for s in range(1, 1024)}])
def test_plan_places_every_piece_once(histogram):
    segments, windows, tail = packing.plan_windows(histogram, 1024)
    spans = defaultdict(list)
    for size, lo, hi, window, copies, offset in segments:
        for rank in range(lo, hi):
            i = rank - lo
            if window >= 0:
                spans[window + i // copies].append((offset + i % copies * size, size))
            else:
                for w, o, n in packing.tail_pieces(offset + i * size, size, tail, 1024):
                    spans[windows + w].append((o, n))
    assert sum(n for x in spans.values() for _, n in x) == sum(s * n for s, n in histogram.items())
    for x in spans.values():
        at = 0
        for o, n in sorted(x):
            assert o == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
