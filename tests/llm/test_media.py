import hashlib
import random
import struct
import zlib

import pytest

from glyphmill.llm import media
from glyphmill.llm.media import box, counted, full


def plain_samples(content):
    """(offset, size, time, sync) of each sample of each track, by naive recursion and loops over every sample."""

    def tree(at, end):
        out = []
        while at < end:
            size, kind = struct.unpack(">I4s", content[at : at + 8])
            head = 8
            if size == 1:
                size, head = struct.unpack(">Q", content[at + 8 : at + 16])[0], 16
            size = size or end - at
            inner = tree(at + head, at + size) if kind in media.HOLDERS else content[at + head : at + size]
            out.append((kind, inner))
            at += size
        return out

    def find(nodes, *path):
        for kind, inner in nodes:
            if kind == path[0]:
                return inner if len(path) == 1 else find(inner, *path[1:])

    def rows(raw, width, size=4):
        n = int.from_bytes(raw[4:8], "big")
        flat = [int.from_bytes(raw[8 + size * i : 8 + size * (i + 1)], "big") for i in range(n * width)]
        return [flat[i : i + width] for i in range(0, len(flat), width)]

    out = []
    for kind, trak in find(tree(0, len(content)), b"moov"):
        if kind != b"trak":
            continue
        table = dict(find(trak, b"mdia", b"minf", b"stbl"))
        if b"stsz" in table:
            size, n = struct.unpack(">II", table[b"stsz"][4:12])
            sizes = [size] * n if size else [struct.unpack(">I", table[b"stsz"][12 + 4 * i : 16 + 4 * i])[0] for i in range(n)]
        else:
            bits, n = struct.unpack(">II", table[b"stz2"][4:12])
            whole = "".join(f"{x:08b}" for x in table[b"stz2"][12:])
            sizes = [int(whole[bits * i : bits * (i + 1)], 2) for i in range(n)]
        chunks = [c for (c,) in (rows(table[b"co64"], 1, 8) if b"co64" in table else rows(table[b"stco"], 1))]
        deal = rows(table[b"stsc"], 3)
        sync = {s - 1 for (s,) in rows(table[b"stss"], 1)} if b"stss" in table else set(range(n))
        steps = [d for k, d in rows(table[b"stts"], 2) for _ in range(k)]
        samples, i = [], 0
        for c, at in enumerate(chunks, 1):
            many = [k for first, k, _ in deal if first <= c][-1]
            for _ in range(many):
                samples.append((at, sizes[i], sum(steps[:i]), i in sync))
                at, i = at + sizes[i], i + 1
        out.append(samples)
    return out


def runs_of(samples, keyframes):
    """Adjoining samples (keyframes only, or all) as ranges."""
    out, last = [], None
    for i, (at, size, time, sync) in enumerate(samples):
        if keyframes and not sync:
            continue
        if out and last == i - 1 and out[-1]["offset"] + out[-1]["size"] == at:
            out[-1]["samples"] += 1
            out[-1]["size"] += size
        else:
            out.append({"sample": i, "samples": 1, "time": time, "offset": at, "size": size})
        last = i
    return out


def picture_file(rng, wide=False, bits=32, sync=True, one_size=False):
    """A file of one picture track with random tables."""
    n_chunks = rng.randint(1, 6)
    deal = [rng.randint(1, 4) for _ in range(n_chunks)]
    n = sum(deal)
    sizes = [7] * n if one_size else [rng.randint(0, 15) for _ in range(n)]
    entry = box(b"avc1", bytes(24), struct.pack(">HH", 640, 360), bytes(50))
    runs = [[k + 1, d, 1] for k, d in enumerate(deal) if not k or deal[k - 1] != d]
    if one_size:
        size_box = full(b"stsz", struct.pack(">II", 7, n))
    elif bits == 32:
        size_box = full(b"stsz", struct.pack(">II", 0, n), b"".join(struct.pack(">I", s) for s in sizes))
    elif bits == 4:
        nibbles = sizes + [0] * (n % 2)
        size_box = full(b"stz2", struct.pack(">II", 4, n), bytes(a << 4 | b for a, b in zip(nibbles[::2], nibbles[1::2], strict=True)))
    else:
        size_box = full(b"stz2", struct.pack(">II", bits, n), b"".join(s.to_bytes(bits // 8, "big") for s in sizes))
    keys = sorted(rng.sample(range(1, n + 1), rng.randint(0, n)))
    k = rng.randint(0, n)

    def file(starts):
        stbl = box(
            b"stbl", full(b"stsd", struct.pack(">I", 1), entry), counted(b"stts", [k, 5, n - k, 9], 2), counted(b"stsc", sum(runs, []), 3),
            size_box, counted(b"co64" if wide else b"stco", starts, 1, wide), *([counted(b"stss", keys)] if sync else []),
        )
        minf = box(b"minf", full(b"hdlr", bytes(4), b"alis", bytes(13)), stbl)
        handler = full(b"hdlr", bytes(4), b"vide", bytes(13))
        mdhd = full(b"mdhd", bytes(16), struct.pack(">IQ", 600, 1234), bytes(4), version=1)
        tkhd = full(b"tkhd", bytes(8), struct.pack(">I", 7), bytes(8), bytes(52), struct.pack(">II", 320 << 16, 180 << 16))
        trak = box(b"trak", tkhd, box(b"mdia", mdhd, handler, minf), box(b"free", bytes(5)))
        return box(b"ftyp", b"isom", bytes(4)) + box(b"free", b"x" * 9) + box(b"moov", trak, box(b"udta", bytes(4)))

    head = len(file([0] * n_chunks)) + 16
    starts, at, i = [], head, 0
    for d in deal:
        at += rng.choice([0, 0, 3])
        starts.append(at)
        at, i = at + sum(sizes[i : i + d]), i + d
    return file(starts) + struct.pack(">I4sQ", 1, b"mdat", 16 + at - head) + bytes(at - head)


@pytest.mark.parametrize("seed", range(40))
def test_random_tables_equal_plain_loops(seed):
    rng = random.Random(seed)
    content = picture_file(rng, wide=seed % 2 == 1, bits=(32, 4, 8, 16)[seed // 2 % 4], sync=seed % 5 > 0, one_size=seed % 7 == 0)
    found = media.read_columns(content)
    assert found["fault"] is None and found["brand"] == "isom"
    (track,), (samples,) = found["tracks"], plain_samples(content)
    assert (track["track_id"], track["handler"], track["codec"], track["timescale"], track["duration"]) == (7, "vide", "avc1", 600, 1234)
    assert (track["width"], track["height"], track["samples"]) == (640, 360, len(samples))
    assert track["keyframes"] == runs_of(samples, True)
    every = [(a, n) for a, n, _, _ in samples]
    covered = [x for r in track["extents"] for x in range(r["offset"], r["offset"] + r["size"])]
    assert covered == [x for a, n in every for x in range(a, a + n)]


def test_fragments():
    """Samples of fragments: durations, sizes and flags of the run, of its header or of the track's defaults."""
    stbl = box(b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"mp4a", bytes(16), struct.pack(">HHHHI", 2, 16, 0, 0, 44100 << 16))), counted(b"stts", [], 2), counted(b"stsc", [], 3), full(b"stsz", bytes(8)), counted(b"stco", []))
    mdia = box(b"mdia", full(b"mdhd", bytes(8), struct.pack(">II", 1000, 0), bytes(4)), full(b"hdlr", bytes(4), b"soun", bytes(13)), box(b"minf", stbl))
    trak = box(b"trak", full(b"tkhd", bytes(8), struct.pack(">I", 1), bytes(68)), mdia)
    trex = full(b"trex", struct.pack(">5I", 1, 1, 20, 4, media.NOT_SYNC))
    start = box(b"ftyp", b"iso5", bytes(4)) + box(b"moov", trak, box(b"mvex", trex))

    def fragment(run, header=b"", flags=media.FROM_MOOF):
        return box(b"moof", full(b"mfhd", bytes(4)), box(b"traf", full(b"tfhd", struct.pack(">I", 1), header, flags=flags), run))

    one = fragment(full(b"trun", struct.pack(">IiI", 3, 0, 0), flags=media.FROM | media.FIRST_FLAGS))
    one = fragment(full(b"trun", struct.pack(">IiI", 3, len(one) + 8, 0), flags=media.FROM | media.FIRST_FLAGS))
    rows = struct.pack(">6I", 5, 2, 6, 3, 7, 1)
    two = fragment(full(b"trun", struct.pack(">Ii", 3, 0), rows, flags=media.FROM | media.DURATIONS | media.SIZES), struct.pack(">I", 0), media.FROM_MOOF | media.FLAGGED)
    two = fragment(full(b"trun", struct.pack(">Ii", 3, len(two) + 8), rows, flags=media.FROM | media.DURATIONS | media.SIZES), struct.pack(">I", 0), media.FROM_MOOF | media.FLAGGED)
    content = start + one + box(b"mdat", bytes(12)) + two + box(b"mdat", bytes(6))
    (track,) = media.read_columns(content)["tracks"]
    first = len(start) + len(one) + 8
    second = first + 12 + len(two) + 8
    assert (track["codec"], track["channels"], track["rate"], track["samples"], track["duration"]) == ("mp4a", 2, 44100, 6, 78)
    assert track["keyframes"] == [{"sample": 0, "samples": 1, "time": 0, "offset": first, "size": 4}, {"sample": 3, "samples": 3, "time": 60, "offset": second, "size": 6}]
    assert track["extents"] == [{"offset": first, "size": 12}, {"offset": second, "size": 6}]


def test_many_samples_of_one_size_take_no_memory():
    """10**9 samples are a handful of ranges."""
    n = 10**9
    stbl = box(b"stbl", full(b"stsd", struct.pack(">I", 0)), counted(b"stts", [n, 1], 2), counted(b"stsc", [1, n, 1], 3), full(b"stsz", struct.pack(">II", 1, n)), counted(b"stco", [0]))
    track = media.Track(tables={})
    for kind, at, end, _ in media.walk(memoryview(stbl)):
        track.tables[kind[-1]] = (at, end)
    media.sample_runs(memoryview(stbl), track)
    assert track.joined().tolist() == [[0, n, 0, 0, n, 1]]


def test_nesting_and_faults():
    deep = b""
    for _ in range(3000):
        deep = box(b"traf", deep)
    assert media.read_columns(deep)["fault"] == "no_movie" and media.read_columns(b"")["fault"] == "empty" and media.read_columns(None)["fault"] == "null"
    good = media.container(bytes(640))
    assert media.read_columns(good)["fault"] is None
    assert media.read_columns(good[:100])["fault"] == "truncated" and media.read_columns(b"abc")["fault"] == "truncated"
    assert media.read_columns(good.replace(b"stco\0\0\0\0\0\0\0\1", b"stco\0\0\0\0\0\0\1\1"))["fault"] == "table_truncated"
    assert media.read_columns(good.replace(b"stco", b"free"))["fault"] == "sample_tables_missing"
    assert media.read_columns(struct.pack(">I4s", 4, b"moov"))["fault"] == "box_size"
    open_end = good.replace(struct.pack(">I4s", 648, b"mdat"), struct.pack(">I4s", 0, b"mdat"))
    assert open_end != good and media.read_columns(open_end)["tracks"] == media.read_columns(good)["tracks"]
    rng = random.Random(9)
    for _ in range(3000):  # whatever a file holds, it is described or has a fault
        broken = bytearray(good)
        for _ in range(rng.randint(1, 4)):
            broken[rng.randrange(570)] = rng.choice([0, 1, 255, rng.randrange(256)])
        media.read_columns(bytes(broken[: rng.choice([len(broken), rng.randrange(len(broken))])]))


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 4095, 4096, 4097, 8192, 300_001])
def test_round_trip(size):
    payload = media.padded(random.Random(size).randbytes(size))
    content = media.container(payload)
    (samples,) = plain_samples(content)
    assert len(payload) % 64 == 0 and b"".join(content[a : a + n] for a, n, _, _ in samples) == payload
    (track,) = media.read_columns(content)["tracks"]
    assert [(r["offset"], r["size"]) for r in track["extents"]] == [(len(content) - len(payload), len(payload))]
    assert track["keyframes"] == runs_of(samples, True) and track["duration"] == len(payload)


def test_offsets_beyond_32_bits(monkeypatch):
    class Long(bytes):
        def __len__(self):
            return 1 << 33

    monkeypatch.setattr(media, "CHUNK", 1 << 24)
    content = media.container(Long())
    assert b"co64" in content and struct.pack(">I4sQ", 1, b"mdat", (1 << 33) + 16) in content


def test_query_and_odd_rows(spark, odd, none):
    assert media.stored(none).count() == 0 and media.media_columns(media.stored(none)).count() == 0
    rows = {r["doc_id"]: r for r in media.media_columns(media.stored(odd).selectExpr("*", "'mine' as box", "1 as tracks")).collect()}
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for d, r in rows.items():
        payload = media.padded((texts[d] or "").encode())
        (track,) = r["tracks"]
        assert r["fault"] is None and r["box"] == "mine" and r["n_bytes"] == len((texts[d] or "").encode())
        assert b"".join(bytes(r["content"])[e["offset"] : e["offset"] + e["size"]] for e in track["extents"]) == payload
        assert (track["codec"], track["duration"], track["samples"]) == ("raw ", len(payload), len(payload) // 64)
    broken = media.media_columns(spark.createDataFrame([(1, None), (2, b"abc"), (3, media.container(bytes(64)))], "id long, content binary")).collect()
    assert [(r["fault"], r["tracks"] is None) for r in broken] == [("null", True), ("truncated", True), (None, False)]


def test_query_digests(spark, texts):
    from tests.llm.conftest import SF

    rows = {r["doc_id"]: r for r in media.op12_media_columns(spark, SF).collect()}
    for d, t in texts:
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        content = media.container(payload)
        r = rows[d]
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(payload), len(content))
        assert (r["payload_sha256"], r["media_sha256"]) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(content).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-64:])
        (samples,) = plain_samples(content)
        keys = ",".join(f"{k['offset']}+{k['size']}" for k in runs_of(samples, True))
        assert r["feature"] == f"codec=raw;duration={len(payload)}/8000;samples={len(payload) // 64};keyframes={keys}"
