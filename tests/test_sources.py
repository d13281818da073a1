"""File formats by round trip, metadata, and the job queue."""

import json
import os
import re
import struct
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_voxels import ARRAY, AXES, C, T, X, Y, Z, array_of
from voxelloom import model, pipeline
from voxelloom.operators.names import DYES
from voxelloom.operators.voxels import Roi
from voxelloom.sources import chunks, metadata, omexml, pages, profile, tiff, zarr
from voxelloom.streaming import queue


@pytest.fixture(scope="module")
def planes(spark):
    rows = [("a", t, z, c, Y, X, "<u2", ARRAY[t, z, c].tobytes()) for t in range(T) for z in range(Z) for c in range(C)]
    return spark.createDataFrame(rows, model.PLANES).cache()


@pytest.mark.parametrize("dtype", ["u1", "<u2", "<i4", "<f4", "<f8"])
@pytest.mark.parametrize("how", [{}, {"deflate": True}, {"big": True}, {"text": "note é", "big": True}, {"text": "x"}])
def test_tiff_round_trip(dtype, how):
    v = (np.arange(3 * 5 * 7).reshape(3, 5, 7) * 1.5).astype(dtype)
    raw = tiff.encode(v, **how)
    out = tiff.decode(raw)
    assert out.dtype == np.dtype(dtype) and (out == v).all() and tiff.description(raw) == how.get("text", "")
    assert (tiff.decode_page(raw, 2) == v[2]).all()
    with pytest.raises(IndexError):
        tiff.decode_page(raw, 3)


def test_tiff_of_the_other_byte_order_and_of_strips():
    data = np.arange(6, dtype=">u2")
    tags = [(256, 4, 1, 3), (257, 4, 1, 2), (258, 3, 1, 16 << 16), (273, 4, 2, 122), (278, 4, 1, 1), (279, 4, 2, 130)]
    raw = struct.pack(">2sHI", b"MM", 42, 8) + struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags) + struct.pack(">I", 0)
    raw = raw.ljust(122, b"\0") + struct.pack(">IIII", 138, 144, 6, 6) + data.tobytes()
    assert (tiff.decode(raw)[0] == data.reshape(2, 3)).all()
    for bad in (b"", b"II", b"PK\x03\x04" + b"\0" * 20):
        with pytest.raises((ValueError, struct.error)):
            tiff.decode(bad)


def test_spacing():
    v = np.zeros((2, 3, 3), "<u2")
    assert tiff.spacing(tiff.encode(v, tiff.imagej_text(v.shape, 0.25))) == 0.25
    assert tiff.spacing(tiff.encode(v, tiff.imagej_text(v.shape))) is None


def test_series_written_and_read(spark, planes, tmp_path):
    folder = str(tmp_path / "s")
    assert tiff.write_series(model.volumes(planes), folder, 0.5) == T * C
    assert sorted(os.listdir(folder))[0] == "a_C0_T000.tif" and len(os.listdir(folder)) == T * C
    assert (array_of(model.voxels(model.planes_of_volumes(tiff.read_volumes(spark, folder))), *AXES) == ARRAY).all()
    rows = pages.read_series(spark, folder)
    assert (array_of(model.voxels(rows), *AXES) == ARRAY).all()
    os.rename(os.path.join(folder, "a_C1_T001.tif"), os.path.join(folder, "a b+%20_C1_T001.tif"))
    with open(os.path.join(folder, "a_C2_T001.tif"), "wb") as f:
        f.write(b"no file that a filter leaves out is opened")
    some = pages.read_series(spark, folder).where("t = 1 and c in (0, 1, 3) and z = 2")
    assert {(r["dataset"], r["t"], r["z"], r["c"]) for r in some.collect()} == {("a", 1, 2, 0), ("a b+%20", 1, 2, 1), ("a", 1, 2, 3)}


def test_ome_read_and_cropped(spark, tmp_path):
    folder = tmp_path / "o"
    folder.mkdir()
    v = ARRAY.reshape(-1, Y, X)
    (folder / "run.ome.tif").write_bytes(tiff.encode(v, tiff.ome_text((T, Z, C, Y, X), "run.ome.tif")))
    rows = tiff.read_ome(spark, str(folder))
    assert (array_of(model.voxels(rows), *AXES) == ARRAY).all()
    for output in ("ZARR", "TIFF_SERIES_SPLIT_C"):
        out = str(tmp_path / output)
        n = pipeline.crop_job(spark, rows, out, output, channels=C, top=Roi(0, 5, 1, 9), bottom=Roi(8, 13, 2, 10), rotate=False)
        assert n == (T * Z * 2 * C if output == "ZARR" else T * 2 * C)
    got = array_of(model.voxels(zarr.read_planes(spark, str(tmp_path / "ZARR"))), *AXES)
    assert got.shape == (T, Z, 2 * C, 5, 8) and (got[:, :, 1] == ARRAY[:, :, 0, 0:5, 1:9]).all()


def test_ome_pages_are_pushed_down_in_files_beyond_2_gb(spark, tmp_path):
    """Only the pages asked for are read, by seeking; the second page's pixels stand past 2 GB of a sparse file."""
    v = ARRAY[0, 0, :2].copy()
    raw = tiff.encode(v, tiff.ome_text((1, 1, 2, Y, X), "big_1.ome.tif"), big=True)
    old = raw.rindex(v[1].tobytes())
    far = 2_300_000_000
    moved = raw.replace((273).to_bytes(2, "little") + (16).to_bytes(2, "little") + (1).to_bytes(8, "little") + old.to_bytes(8, "little"), (273).to_bytes(2, "little") + (16).to_bytes(2, "little") + (1).to_bytes(8, "little") + far.to_bytes(8, "little"))
    assert moved != raw
    with open(tmp_path / "big_1.ome.tif", "wb") as f:
        f.write(moved)
        f.seek(far)
        f.write(v[1].tobytes())
    rows = tiff.read_ome(spark, str(tmp_path))
    assert {(r["dataset"], r["c"]): bytes(r["data"]) for r in rows.collect()} == {("big", c): v[c].tobytes() for c in (0, 1)}
    one = rows.where("c = 1")
    assert bytes(one.first()["data"]) == v[1].tobytes() and one.count() == 1 and rows.where("c = 5").count() == 0


def test_pages_are_found_by_an_index(spark, planes, tmp_path):
    """Once there is an index, pages are read without directories or XML; it is built again when files change, and comparisons prune it."""
    folder = str(tmp_path)
    tiff.write_ome(planes, folder)
    found = pages.page_index(spark, folder)
    assert found.count() == T * Z * C and {r["file"] for r in found.collect()} == {f"a_{t}.ome.tif" for t in range(T)}
    rows = tiff.read_ome(spark, folder)
    assert (array_of(model.voxels(rows), *AXES) == ARRAY).all()
    state = os.path.join(folder, pages.INDEX, ".state")
    before = os.stat(state).st_mtime_ns
    for t in range(T):  # no directory stands where the header says
        path = os.path.join(folder, f"a_{t}.ome.tif")
        times = os.stat(path)
        with open(path, "r+b") as f:
            f.seek(4)
            f.write(b"\xff\xff\xff\x7f")
        os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    rows = tiff.read_ome(spark, folder)
    assert os.stat(state).st_mtime_ns == before and (array_of(model.voxels(rows), *AXES) == ARRAY).all()
    for where in ("t > 0 and z <= 1", "t >= 1 and t < 2 and c in (1, 3)", "t = 0 and z > 90"):
        some, want = rows.where(where), planes.where(where)
        assert sorted((r["t"], r["z"], r["c"], bytes(r["data"])) for r in some.collect()) == sorted((r["t"], r["z"], r["c"], bytes(r["data"])) for r in want.collect())
    plan = rows.where("t = 1 and z > 2")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(t,1), GreaterThan(z,2)" in plan
    os.remove(os.path.join(folder, "a_0.ome.tif"))
    tiff.write_ome(planes, folder)
    assert tiff.read_ome(spark, folder).where("t = 1").count() == Z * C and os.stat(state).st_mtime_ns != before


def test_index_of_many_pages_and_nested_folders(spark, tmp_path):
    """A hundred thousand pages in one file, and files further down; names with signs that XML escapes."""
    n = 100_000
    name = "a&b_MMStack_Pos0.ome.tif"
    text = tiff.ome_text((n // 10, 5, 2, 1, 1), "NAME").replace("NAME", "a&amp;b_MMStack_Pos0.ome.tif")
    v = np.arange(n, dtype="<u4").reshape(n, 1, 1)
    deep = tmp_path / "d" / "e"
    deep.mkdir(parents=True)
    (deep / name).write_bytes(tiff.encode(v, text, big=True))
    assert pages.page_index(spark, str(tmp_path)).count() == 0
    assert pages.page_index(spark, str(tmp_path), recursive=True).count() == n
    rows = tiff.read_ome(spark, str(tmp_path), recursive=True)
    one = rows.where("t = 7777 and z = 3 and c = 1")
    assert [int.from_bytes(r["data"], "little") for r in one.collect()] == [(7777 * 5 + 3) * 2 + 1] and one.first()["dataset"] == "a&b_MMStack_Pos0"
    assert one.count() == 1 and pages.tasks_for(n) == one.rdd.getNumPartitions() == -(-n // pages.PAGES)


def test_acquisitions_are_streamed_once(spark, tmp_path):
    """New files only, from any depth, over runs that go on from one checkpoint."""
    folder, seen = tmp_path / "in", []

    def put(name):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"x" * 7)

    def run(per_batch=1000):
        before = len(seen)
        query = pages.acquisitions(spark, str(folder), per_batch).writeStream.foreachBatch(lambda rows, n: seen.extend((n, r["path"].rpartition("/in/")[2], r["length"]) for r in rows.collect()))
        query.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        return sorted(x[1] for x in seen[before:])

    for name in ("a/b/r_MMStack_Pos0.ome.tif", "r_MMStack_Pos0.ome.tif", "a/r_MMStack_Pos0_1.ome.tif", "a/b/c/d/e_MMStack_Pos0.ome.tif"):
        put(name)
    assert run(1) == ["a/b/c/d/e_MMStack_Pos0.ome.tif", "a/b/r_MMStack_Pos0.ome.tif", "r_MMStack_Pos0.ome.tif"] and len({x[0] for x in seen}) == 3
    assert run() == []
    put("z/q_MMStack_Pos0.ome.tif")
    assert run() == ["z/q_MMStack_Pos0.ome.tif"] and all(x[2] == 7 for x in seen)


def lzw(data, clear_at=4094):
    """Codes of the TIFF specification's encoder, packed highest bit first."""
    bits, width, table, held = [], 9, {bytes([k]): k for k in range(256)}, b""
    put = lambda code: bits.append(f"{code:0{width}b}")
    put(256)
    for k in range(len(data)):
        b = data[k : k + 1]
        if held + b in table:
            held += b
            continue
        put(table[held])
        table[held + b] = len(table) + 2
        if len(table) + 2 > (1 << width) - 1:
            width += 1
        if len(table) + 2 > clear_at:
            put(256)
            table, width = {bytes([k]): k for k in range(256)}, 9
        held = b
    if held:
        put(table[held])
    width = min(12, max(width, (len(table) + 3).bit_length()))
    put(257)
    joined = "".join(bits)
    return int(joined.ljust(-(-len(joined) // 8) * 8, "0"), 2).to_bytes(-(-len(joined) // 8), "big")


def test_lzw_pages():
    codes = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 6, 257)).ljust(88, "0")
    assert tiff.unlzw(int(codes, 2).to_bytes(11, "big")) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    rng = np.random.default_rng(1)
    for size, top in ((0, 2), (1, 2), (700, 2), (5000, 256), (40_000, 5), (60_000, 256)):
        data = rng.integers(0, top, size).astype(np.uint8).tobytes()
        assert tiff.unlzw(lzw(data)) == data, (size, top)
    with pytest.raises(ValueError, match="broken"):
        tiff.unlzw(int(f"{256:09b}{300:09b}".ljust(24, "0"), 2).to_bytes(3, "big"))
    v = rng.integers(0, 60_000, (7, 9)).astype("<u2")
    raw = v.tobytes()
    steps = np.diff(v, axis=1, prepend=np.zeros((7, 1), "<u2")).astype("<u2").tobytes()
    for packed, predictor, kind in ((lzw(raw), 1, "<u2"), (lzw(steps), 2, "<u2"), (zlib.compress(steps), 2, "<u2")):
        page = tiff.Layout(7, 9, kind, tiff.LZW if packed != zlib.compress(steps) else tiff.DEFLATE, predictor, [3], [len(packed)])
        assert (tiff.image_at(b"xyz" + packed, page) == v).all()
    for bad in (tiff.Layout(7, 9, "<u2", 7, 1, [0], [1]), tiff.Layout(7, 9, "<f4", 1, 2, [0], [1]), tiff.Layout(7, 9, "<u2", 1, 3, [0], [1])):
        with pytest.raises(ValueError, match="not supported"):
            tiff.image_at(b"x", bad)


def blosc(data, size, block, codec, shuffle=True, split=True):
    """A Blosc frame by its public description."""
    flags = (1 if shuffle else 0) | (0 if split else 16) | codec << 5
    name = {1: "lz4_raw", 2: "snappy", 3: None, 4: "zstd"}[codec]
    starts, body = [], b""
    head = 16 + 4 * -(-len(data) // block)
    for k in range(0, len(data), block):
        part = data[k : k + block]
        if shuffle:
            n = len(part) // size
            part = np.frombuffer(part, np.uint8, n * size).reshape(n, size).T.tobytes() + part[n * size :]
        streams = size if split and size <= 16 and block // size >= 128 and len(part) == block else 1
        starts.append(head + len(body))
        for j in range(streams):
            raw = part[j * len(part) // streams : (j + 1) * len(part) // streams]
            packed = zlib.compress(raw) if name is None else pa.Codec(name).compress(raw, asbytes=True)
            packed = packed if len(packed) < len(raw) else raw
            body += struct.pack("<i", len(packed)) + packed
    out = struct.pack("<BBBBIII", 2, 1, flags, size, len(data), block, head + len(body))
    return out + struct.pack(f"<{len(starts)}I", *starts) + body


@pytest.mark.parametrize("codec", [1, 2, 3, 4])
def test_blosc_frames(codec):
    rng = np.random.default_rng(2)
    for v in (np.arange(5000, dtype="<u2"), rng.integers(0, 9, 3001).astype("<u4"), rng.standard_normal(700), np.arange(9, dtype="u1"), rng.integers(0, 256, 4096).astype("u1")):
        for shuffle in (True, False):
            for split in (True, False):
                assert chunks.unblosc(blosc(v.tobytes(), v.itemsize, 2048, codec, shuffle, split)) == v.tobytes()
    assert chunks.unblosc(struct.pack("<BBBBIII", 2, 1, 2 | 1 << 5, 2, 4, 4, 20) + b"abcd") == b"abcd"
    for flags in (0, 1 | 5 << 5, 4 | 1 << 5):
        with pytest.raises(ValueError, match="not supported"):
            chunks.unblosc(struct.pack("<BBBBIII", 2, 1, flags, 2, 4, 4, 20) + b"abcd")


def test_zarr_array_is_written_in_two_phases(spark, planes, tmp_path):
    folder, times = str(tmp_path / "z.zarr"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            times.add(b.num_rows)
            yield b

    assert zarr.write_planes(planes.mapInArrow(counted, model.PLANES), folder) == T * Z * C == times.value
    (tmp_path / "z.zarr" / "note.json").write_text("{}")
    whole = lambda: (array_of(model.voxels(zarr.read_planes(spark, folder)), *AXES) == ARRAY).all() and sorted(os.listdir(tmp_path)) == ["z.zarr"]

    def killed(batches):
        for b in batches:
            yield b
        os.kill(os.getpid(), 9)

    bad = spark.createDataFrame([("a", 0, 0, 0, Y, X, "<u2", b"x")], model.PLANES)
    other = planes.where("t = 0 and z = 0 and c = 0")
    for rows in (planes.mapInArrow(killed, model.PLANES), bad, planes.unionByName(other.withColumn("dataset", F.lit("b"))), planes.unionByName(other.withColumn("dtype", F.lit("<i2"))), planes.where("false")):
        with pytest.raises(Exception):
            zarr.write_planes(rows, folder)
        assert whole() and (tmp_path / "z.zarr" / "note.json").exists()
    with pytest.raises(Exception, match="not added to"):
        planes.write.format("zarr").mode("append").save(folder)
    # read from the folder that is written, and the array's other files stay
    assert zarr.write_planes(zarr.read_planes(spark, folder).where("t < 1"), folder, compress=True) == Z * C
    assert (array_of(model.voxels(zarr.read_planes(spark, folder)), *AXES) == ARRAY[:1]).all() and (tmp_path / "z.zarr" / "note.json").exists()


def test_zarr_scan_opens_what_filters_allow(spark, tmp_path):
    """One of a thousand chunks: all others are no chunks at all, so opening one would fail."""
    v = np.arange(10 * 10 * 10, dtype="<u2")
    folder = str(tmp_path / "a.zarr")
    zarr.write_planes(spark.createDataFrame([("a", int(i) // 100, int(i) // 10 % 10, int(i) % 10, 1, 1, "<u2", i.tobytes()) for i in v], model.PLANES), folder)
    for name in os.listdir(folder):
        if name != "3.7.2.0.0" and not name.startswith("."):
            (tmp_path / "a.zarr" / name).write_bytes(b"no chunk")
    rows = chunks.scan(spark, folder)
    one = rows.where("t = 3 and z > 6 and z <= 7 and c in (2, 40)")
    assert [(r["t"], r["z"], r["c"], bytes(r["data"])) for r in one.collect()] == [(3, 7, 2, v[372].tobytes())]
    assert rows.where("t = 99").count() == 0
    with pytest.raises(Exception):
        rows.collect()


def test_zarr_scan_of_others(spark, tmp_path):
    """Chunks in y and x, axes of a store, missing chunks, fill values, separators, Blosc as other software writes it."""
    v = np.arange(2 * 3 * 5 * 7 * 6, dtype=">u2").reshape(2, 3, 5, 7, 6)
    store = tmp_path / "s.ome.zarr" / "0"
    store.mkdir(parents=True)
    (tmp_path / "s.ome.zarr" / ".zattrs").write_text(json.dumps({"multiscales": [{"axes": [{"name": a} for a in "tczyx"]}]}))
    meta = {"zarr_format": 2, "shape": list(v.shape), "chunks": [1, 1, 2, 4, 5], "dtype": ">u2", "compressor": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1, "blocksize": 0}, "fill_value": 9, "order": "C", "filters": None, "dimension_separator": "/"}
    (store / ".zarray").write_text(json.dumps(meta))
    want = v.copy()
    for k in np.ndindex(2, 3, 3, 2, 2):
        part = np.zeros(meta["chunks"], ">u2")
        cut = tuple(slice(i * n, (i + 1) * n) for i, n in zip(k, meta["chunks"]))
        part[tuple(slice(0, n) for n in v[cut].shape)] = v[cut]
        if k[:3] == (1, 2, 2) or k == (0, 0, 0, 1, 1):
            want[cut] = 9
            continue
        path = store / "/".join(map(str, k))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(blosc(part.tobytes(), 2, 64, 1))
    rows = chunks.scan(spark, str(store))
    got = {(r["t"], r["c"], r["z"]): np.frombuffer(r["data"], r["dtype"]).reshape(r["h"], r["w"]) for r in rows.collect()}
    assert len(got) == 30 and all((got[k] == want[k]).all() for k in got)
    assert rows.where("z = 4").count() == 6 and chunks.scan(spark, str(store), missing="skip").count() == 29
    (store / ".zarray").write_text(json.dumps({**meta, "compressor": {"id": "lzma"}}))
    with pytest.raises(Exception, match="not supported"):
        chunks.scan(spark, str(store)).collect()


def test_both_ways_of_reading_ome_agree(spark, planes, tmp_path):
    assert tiff.write_ome(planes, str(tmp_path)) == T
    rows = tiff.read_ome(spark, str(tmp_path))
    # each use has its own filters
    ones, twos = (rows.where(f"t = {t}").select("t") for t in (0, 1))
    assert sorted(r["t"] for r in ones.unionByName(twos).collect()) == [0] * Z * C + [1] * Z * C and rows.count() == T * Z * C
    read = lambda rows: array_of(model.voxels(rows), *AXES)
    assert (read(tiff.read_ome(spark, str(tmp_path))) == ARRAY).all() and (read(tiff.read_ome_whole(spark, str(tmp_path))) == ARRAY).all()


def test_ome_attributes_in_any_order(spark):
    text = """<OME:TiffData PlaneCount="1" IFD='4' FirstT="2" FirstC="1"><UUID FileName="a &amp; b.tif">x</UUID></OME:TiffData><TiffData FirstC="3"/><TiffData IFD="5" FirstZ="6"><UUID FileName="c.tif"/></TiffData>"""
    want = {(1, 0, 2, "a & b.tif", 4), (0, 6, 0, "c.tif", 5)}
    got = omexml.frame_map(spark.createDataFrame([(text,)], "xml string")).collect()
    assert {(r["c"], r["z"], r["t"], r["file"].replace("&amp;", "&"), r["ifd"]) for r in got} == want


def test_tickets_are_honoured(spark, tmp_path):
    from voxelloom.functions import kernels as K

    data = str(tmp_path / "d")
    os.makedirs(data)
    rng = np.random.default_rng(5)
    v = rng.integers(200, 900, (5, 7, 9)).astype("<u2")
    for c in (0, 1):
        with open(os.path.join(data, f"x_C{c}_T000.tif"), "wb") as f:
            f.write(tiff.encode(v + c))
    psf = np.zeros((3, 3, 3), "<u2")
    psf[1, 1, 1], psf[0, 1, 1] = 9, 3
    psf_path = str(tmp_path / "psf.tif")
    with open(psf_path, "wb") as f:
        f.write(tiff.encode(psf))
    jobs = pipeline.handlers(spark)
    base = {"z_step_um": 1.0, "xy_pixel_size": 1.0, "sheet_angle_deg": 60.0}

    def run(folder="DSR", **p):
        jobs["deskew"]({"dataDir": data, "baseName": "x", "parameters": {**base, **p}})
        return {r["c"]: model.pixels(r["data"], r["dtype"], r["nz"], r["ny"], r["nx"]) for r in tiff.read_volumes(spark, os.path.join(data, folder)).collect()}

    saved = lambda x: np.clip(np.floor(x + 0.5), 0, 65535)
    s, c = np.sin(np.pi / 3), np.cos(np.pi / 3)
    plain = run()
    assert set(plain) == {0, 1} and (plain[0] == saved(K.deskew_rotate(v, 60.0, s))).all()
    assert (run(reverse=True)[0] == saved(K.deskew_rotate(v, 60.0, s, True))).all()
    assert (run(objective_scan=True)[0] == saved(K.deskew_rotate(v, 60.0, 1.0, False, True))).all()
    assert (run(z_stage_scan=True)[0] == saved(K.deskew_rotate(v, 30.0, c, True))).all()
    assert set(run(channel_patterns=["_C1_"])) == {1}  # and what the run before left for channel 0 is gone
    assert (run("DS", rotate=False)[0] == saved(K.deskew(v, c))).all() and "mine" not in os.listdir(data) and (run("mine", rotate=False, ds_dir_name="mine")[1] == saved(K.deskew(v + 1, c))).all()
    assert (run("level", dsr_dir_name="level")[0] == plain[0]).all()
    assert (run(input_axis_order="xyz")[0] == saved(K.deskew_rotate(v.transpose(0, 2, 1), 60.0, s))).all()
    assert (run(output_axis_order="yzx")[0] == saved(K.deskew_rotate(v, 60.0, s).transpose(2, 1, 0))).all()
    assert (run(psf_path=psf_path, dz_psf=s, run_decon=False)[0] == plain[0]).all()
    assert (run("Decon", psf_path=psf_path, deskew=False, rotate=False, rl_method="omw")[0] == saved(K.richardson_lucy(v, psf.astype(float), 2))).all()
    for wrong in ({"interp_method": "cubic"}, {"deskew": False, "rotate": True}, {"objective_scan": True, "z_stage_scan": True}, {"input_axis_order": "yyz"}):
        with pytest.raises(ValueError):
            run(**wrong)


def test_active_dyes_and_repeated_channels(spark, planes):
    from voxelloom.operators.names import active_outputs

    assert active_outputs([0, 1, 2, 3, 5], ["GFP"]) == [1, 5] and active_outputs([0, 3], None) == [0, 3]
    twice = pipeline.crop_planes(planes, C, Roi(0, 5, 1, 9), Roi(8, 13, 2, 10), "blocked", wanted=[1, 2, 1], rotate=False)
    got = {r["c"]: bytes(r["data"]) for r in twice.where("t = 0 and z = 0").collect()}
    assert set(got) == {0, 1, 2} and got[0] == got[2] != got[1]


def test_single_exposures_are_named_by_dye(spark, planes, tmp_path):
    tiff.write_ome(planes, str(tmp_path / "in"))
    run = lambda **p: pipeline.handlers(spark)["crop"]({"dataDir": str(tmp_path / "in" / "a_0.ome.tif"), "baseName": "out", "parameters": {"rois": {"top": "0:5,1:9", "bottom": "8:13,2:10"}, **p}})
    run(channels=[0, 1], exposure_mode="Single Exposure (All Lasers)")
    out = str(tmp_path / "in" / "out")
    names = {n for n in os.listdir(out) if n.endswith(".tif")}
    assert len(names) == 2 * T and {re.search("_(" + "|".join(DYES) + r")_T\d{4}\.tif$", n)[1] for n in names} == set(DYES[:2])
    named = tiff.read_volumes(spark, out, labels=DYES[:2]).collect()
    run(channels=[0, 1], exposure_mode="Sequential")
    assert not any(d in n for n in os.listdir(out) for d in DYES)
    plain = tiff.read_volumes(spark, out).collect()
    assert {(r["t"], r["c"], bytes(r["data"])) for r in named} == {(r["t"], r["c"], bytes(r["data"])) for r in plain} and len(named) == 2 * T
    with pytest.raises(ValueError, match="share a label"):
        run(channels=[0, 4], exposure_mode="Single Exposure (All Lasers)")


def test_waiting_for_a_job(spark, tmp_path):
    with pytest.raises(TimeoutError):
        queue.wait_for_job(spark, str(tmp_path / "none"), "a.json", timeout_s=0.1, pause_s=0.05)
    spark.createDataFrame([("a.json", "crop", "failed", "x")], "ticket string, route string, state string, error string").withColumn("ts", F.current_timestamp()).write.parquet(str(tmp_path / "r"))
    assert queue.wait_for_job(spark, str(tmp_path / "r"), "a.json") == "failed"


def test_ome_xml(spark):
    text = tiff.ome_text((2, 3, 2, 4, 5), "f.ome.tif").replace("<Pixels", '<Pixels PhysicalSizeX="0.2"')
    xml = spark.createDataFrame([("f.ome.tif", text), ("g", "<OME/>")], "file string, xml string")
    got = {r["file"]: r for r in omexml.header(xml).collect()}
    assert (got["f.ome.tif"]["SizeC"], got["f.ome.tif"]["SizeZ"], got["f.ome.tif"]["PhysicalSizeX"]) == (2, 3, 0.2)
    assert (got["g"]["SizeT"], got["g"]["PhysicalSizeX"], got["g"]["PhysicalSizeZ"]) == (1, 0.1, 1.0)
    frames = omexml.frame_map(xml)
    assert frames.count() == 12
    sizes = {"SizeC": 2, "SizeZ": 3, "SizeT": 2}
    assert omexml.get_frame(frames, sizes, 1, 2, 1).first()["ifd"] == 11
    with pytest.raises(IndexError):
        omexml.get_frame(frames, sizes, 2, 0, 0)
    with pytest.raises(LookupError):
        omexml.get_frame(frames.where("t = 0"), sizes, 1, 0, 0)


def test_earlier_outputs_are_cleared(spark, planes, tmp_path):
    """A smaller array or series takes the place of a larger one whole; other files and the source's own stay."""
    folder = str(tmp_path / "z.zarr")
    zarr.write_planes(planes, folder)
    open(os.path.join(folder, queue.CROP_SETTINGS), "w").close()
    small = planes.where("t < 1 and z < 2")
    assert zarr.write_planes(small, folder) == 2 * C and os.path.exists(os.path.join(folder, queue.CROP_SETTINGS))
    assert (array_of(model.voxels(zarr.read_planes(spark, folder)), *AXES) == ARRAY[:1, :2]).all()
    parts, tall = str(tmp_path / "parts"), np.zeros((zarr.SLAB + 1, 2, 2), "<u2")
    for v in (tall, tall[:3]):
        zarr.write_volumes(spark.createDataFrame([("a", 0, 0, *v.shape, "<u2", v.tobytes())], model.VOLUMES), parts, "b")
    assert sorted(os.listdir(os.path.join(parts, "b_T0000_C0.zarr"))) == [".zarray", "0.0.0"]
    series = str(tmp_path / "series")
    tiff.write_series(model.volumes(planes), series)
    open(os.path.join(series, "note.txt"), "w").close()
    pipeline.clear_series(series, series)
    assert len(os.listdir(series)) == T * C + 1
    pipeline.clear_series(series, str(tmp_path))
    assert os.listdir(series) == ["note.txt"]


@pytest.mark.parametrize("compress", [False, True])
def test_zarr_arrays_and_store(spark, planes, tmp_path, compress):
    folder = str(tmp_path / "z.zarr")
    assert zarr.write_planes(planes, folder, compress) == T * Z * C
    assert (array_of(model.voxels(zarr.read_planes(spark, folder)), *AXES) == ARRAY).all()
    parts = str(tmp_path / "parts")
    gaps = model.volumes(planes).withColumns({"t": F.col("t") * 3 + 1, "c": F.col("c") * 2})
    assert zarr.write_volumes(gaps, parts, "b", compress) == T * C
    assert (array_of(model.voxels(model.planes_of_volumes(zarr.read_volumes(spark, parts, "b").withColumns({"t": ((F.col("t") - 1) / 3).cast("int"), "c": (F.col("c") / 2).cast("int")}))), *AXES) == ARRAY).all()
    assert zarr.consolidate(spark, parts, "b", 0.1, 2.0) == T * C
    assert zarr.consolidate(spark, parts, "b", 0.1, 2.0, ["k", "l", "m", "n"]) == T * C
    store = os.path.join(parts, "b.ome.zarr")
    attributes = json.load(open(os.path.join(store, ".zattrs")))
    assert [c["label"] for c in attributes["omero"]["channels"]] == ["k", "l", "m", "n"]
    assert attributes["multiscales"][0]["datasets"][0]["coordinateTransformations"][0]["scale"] == [2.0, 1.0, 0.1, 0.1, 0.1]
    assert (array_of(model.voxels(zarr.read_planes(spark, os.path.join(store, "0"))), *AXES) == ARRAY).all()
    assert zarr.consolidate(spark, parts, "nothing", 0.1, 2.0) == 0


def test_acquisition_metadata(spark, tmp_path):
    for name, raw in (("a", b'{"stepSizeUm": 0.4, "unit": "\xb5m"}'), ("b", b'{"zStep_um": 0, "timepointInterval": 2}'), ("c", b"{broken")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "AcqSettings.txt").write_bytes(raw)
    got = {r["path"].split("/")[-2]: r["z_step"] for r in metadata.z_step(metadata.acquisition_settings(spark, str(tmp_path))).collect()}
    assert got == {"a": 0.4, "b": 0.0, "c": 1.0}
    frames = tmp_path / "x_metadata.txt"
    frames.write_text(json.dumps({"Summary": {}, "FrameKey-0-0-0": {"ElapsedTime-ms": 1500.0}, "FrameKey-2-0-0": {"ElapsedTime-ms": 9000}, "FrameKey-1-0-1": {"ElapsedTime-ms": 1}}))
    assert metadata.timestamps(spark, str(frames), 4, 6.0) == [1.5, 6.0, 9.0, 18.0]
    assert metadata.timestamps(spark, str(tmp_path / "none"), 2, 3.0) == [0.0, 3.0]
    log = metadata.processing_log("s", "m", "ZARR", [0, 2], Roi(1, 2, 3, 4), None, True, [0.0])
    assert log["rois"] == {"top_roi": ["1:2", "3:4"], "bottom_roi": None} and log["channels_exported"] == [0, 2]
    sidecar = str(tmp_path / "settings.json")
    assert metadata.merge_settings(sidecar, {"deskew": {"angle": 1}, "x": 2}) == {"deskew": {"angle": 1}, "x": 2}
    assert metadata.merge_settings(sidecar, {"deskew": None, "y": 3}) == {"x": 2, "y": 3}


def test_profile_pages(spark, tmp_path):
    row = lambda f, t: f"<tr><td class=x><a href='#'>{f}</a></td><td>3</td><td>{t}</td></tr>"
    pages = {
        "j1": row("readzarr", "1.5 s") + row("decon_lucy_function", "10 s") + row("run_gpu_pipeline", "20 s") + "<tr><td>short</td></tr>",
        "j2": row("readtiff", "2 s") + row("readzarr", "1 s") + row("gpuArray.imwarp", "n/a") + row("writezarr", "4 s"),
    }
    for job, rows in pages.items():
        (tmp_path / f"{job}_html").mkdir()
        (tmp_path / f"{job}_html" / "file0.html").write_text(f"<table>{rows}</table>")
    jobs = profile.summarise(profile.read(spark, str(tmp_path / "*_html" / "file0.html")))
    assert {r["job"]: (r["load"], r["decon"], r["dsr"], r["save"], r["total"]) for r in jobs.collect()} == {"j1": (1.5, 10, 0, 0, 20), "j2": (3, 0, 0, 4, 7)}
    assert profile.averages(jobs).first()["total"] == 13.5


def test_tickets(tmp_path):
    folder = str(tmp_path)
    path = queue.submit_crop(folder, "/x/my é run.ome.tif", "0:4,0:4", None, [0, 1], timepoints=[1])
    assert os.path.basename(path).startswith("CROP_my_é_run_") and json.load(open(path))["baseName"] == "my é run"
    p = json.load(open(queue.submit_crop(folder, "/x/r.tif", None, "0:4,0:4", [2], exposure_mode="sequential", test=True)))
    assert p["baseName"] == "r_test" and p["parameters"]["rois"] == {"bottom": "0:4,0:4"} and p["parameters"]["exposure_mode"] == "sequential"
    ticket, target = queue.submit_crop_with_settings(folder, str(tmp_path / "s.ome.tif"), "0:4,0:4", None, [0, 1], rotate=False)
    settings = json.load(open(os.path.join(target, queue.CROP_SETTINGS)))
    assert target == str(tmp_path / "s") and settings == {"source_file": "s.ome.tif", "rois": {"top": "0:4,0:4"}, "channels": [0, 1], "rotate": False, "format": "TIFF_SERIES_SPLIT_C"}
    assert json.load(open(ticket))["dataDir"] == str(tmp_path / "s.ome.tif")
    assert json.load(open(queue.submit_decon(folder, "/d", ["p.tif"], rl_method="omw")))["parameters"]["iterations"] == 2
    assert json.load(open(queue.submit_deskew(folder, "/d", 1.0, 30.0, 0.1, psf_path="p")))["parameters"]["decon_iter"] == 25
    psf = tmp_path / "psf.tif"
    psf.write_bytes(tiff.encode(np.zeros((2, 3, 3), "<u2")))
    with pytest.raises(ValueError):
        queue.submit_pipeline(folder, "/o/x", "/s", [str(psf)], 1.0, 0.1, 30.0)
    p = json.load(open(queue.submit_pipeline(folder, "/o/x", "/s", [str(psf)], 1.0, 0.1, 30.0, dz_psf=0.2, z_crop_end=5)))["parameters"]
    assert (p["dz_psf"], p["z_crop_end"]) == (0.2, 5)
    assert "psf_paths" in json.load(open(queue.submit_pipeline(folder, "/o/x", "/s", [], 1.0, 0.1, 30.0)))["parameters"]


def test_each_channel_has_its_psf(spark, tmp_path):
    data = str(tmp_path / "data")
    os.makedirs(data)
    rng = np.random.default_rng(3)
    images = {c: rng.integers(200, 900, (4, 7, 7)).astype("<u2") for c in (0, 1)}
    for c, v in images.items():
        with open(os.path.join(data, f"x_C{c}_T000.tif"), "wb") as f:
            f.write(tiff.encode(v))
    paths = []
    for c in (0, 1):
        psf = np.zeros((3, 5, 5), "<u2")
        psf[1, 2, 2] = 4
        psf[1, 2, 2 + c] = 4
        paths.append(str(tmp_path / f"psf{c}.tif"))
        with open(paths[-1], "wb") as f:
            f.write(tiff.encode(psf))
    jobs = pipeline.handlers(spark)
    read = lambda name: {r["c"]: bytes(r["data"]) for r in tiff.read_volumes(spark, os.path.join(data, name)).collect()}
    run = lambda name, **how: jobs["decon"]({"dataDir": data, "baseName": "x", "parameters": {"iterations": 3, "result_dir_name": name, **how}}) or read(name)
    one, other = (run(f"one{c}", psf_paths=[paths[c]]) for c in (0, 1))
    both = run("both", psf_paths=paths, channel_patterns=["_C0_", "_C1_"])
    assert one[1] != other[1] and both == {0: one[0], 1: other[1]}
    with pytest.raises(ValueError, match="2 PSFs"):
        run("bad", psf_paths=paths, channel_patterns=["_C0_"])


def test_a_repeated_job_makes_only_what_is_missing_or_stale(spark, tmp_path):
    data = str(tmp_path / "data")
    os.makedirs(data)

    def put(c, t, k):
        with open(os.path.join(data, f"x_C{c}_T{t:03d}.tif"), "wb") as f:
            f.write(tiff.encode(np.full((3, 6, 6), 100 * c + 10 * t + k, "<u2")))

    for c in (0, 1):
        for t in range(3):
            put(c, t, 0)
    job = {"dataDir": data, "baseName": "x", "parameters": {"z_step_um": 1.0, "xy_pixel_size": 1.0, "sheet_angle_deg": 45.0}}
    deskew, out = pipeline.handlers(spark)["deskew"], os.path.join(data, "DSR")
    times = lambda: {n: os.stat(os.path.join(out, n)).st_mtime_ns for n in os.listdir(out) if n.endswith(".tif")}
    seen: dict = {}

    def made(**more):
        """Names of the files that a run made."""
        deskew({**job, "parameters": {**job["parameters"], **more}})
        before, now = dict(seen), times()
        seen.clear()
        seen.update(now)
        return {n for n in now if now[n] != before.get(n)}

    every = {f"x_C{c}_T{t:03d}.tif" for c in (0, 1) for t in range(3)}
    assert made() == every and made() == set()
    put(1, 2, 5)
    assert made() == {"x_C1_T002.tif"}
    os.remove(os.path.join(out, "x_C0_T000.tif"))
    os.remove(os.path.join(data, "x_C0_T001.tif"))
    open(os.path.join(out, "note.txt"), "w").close()
    assert made() == {"x_C0_T000.tif"} and set(times()) == every - {"x_C0_T001.tif"} and os.path.exists(os.path.join(out, "note.txt"))
    assert made(sheet_angle_deg=30.0) == every - {"x_C0_T001.tif"}


def test_queue_runs_jobs_once_and_records_failures(spark, planes, tmp_path):
    tickets, data = str(tmp_path / "tickets"), str(tmp_path / "data")
    tiff.write_series(model.volumes(planes), data)
    handled = []
    jobs = pipeline.handlers(spark)
    noted = {k: (lambda job, k=k: (handled.append(k), jobs[k](job))) for k in jobs}
    ok = queue.submit_deskew(tickets, data, 1.0, 45.0, 1.0)
    bad = queue.submit(tickets, "DECON", "decon", data, "x", {})
    queue.submit(tickets, "ZZ", "no such type", data, "x", {"z_step_um": 1.0, "xy_pixel_size": 1.0, "sheet_angle_deg": 45.0})
    run = lambda: queue.run_queue(spark, tickets, noted, str(tmp_path / "results"), str(tmp_path / "check")).awaitTermination()
    run()
    run()
    assert handled == ["decon", "deskew", "deskew"]
    results = spark.read.parquet(str(tmp_path / "results"))
    seen = []
    queue.watch_job(spark, str(tmp_path / "results"), os.path.basename(ok), lambda *x: seen.append(x)).join(60)
    queue.watch_job(spark, str(tmp_path / "results"), "none.json", lambda *x: seen.append(x), timeout_s=0).join(60)
    assert [x[0] for x in seen] == ["completed", "timeout"]
    assert queue.wait_for(results, os.path.basename(ok)) == "completed" and queue.wait_for(results, os.path.basename(bad)) == "failed"
    assert "needs a PSF" in results.where("state = 'failed'").first()["error"]
    assert len([n for n in os.listdir(os.path.join(data, "DSR")) if n.endswith(".tif")]) == T * C
    listed = spark.read.schema(queue.TICKET).option("multiLine", "true").json(tickets).withColumn("ticket", F.col("_metadata.file_name"))
    assert [r["dataDir"] for r in queue.pending_consolidations(results, listed).collect()] == [data]


def test_state_machine_and_idle_gaps(spark, tmp_path):
    source = str(tmp_path / "events")
    rows = [("a", "queued", 0), ("a", "active", 5), ("a", "queued", 6), ("b", "queued", 1), ("b", "failed", 9), ("b", "completed", 20), ("c", "odd", 3)]
    start = time.mktime((2024, 1, 1, 0, 0, 0, 0, 0, 0))
    spark.createDataFrame([(t, s, float(start + k)) for t, s, k in rows], "ticket string, state string, s double").select("ticket", "state", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("ticket string, state string, ts timestamp").parquet(source)
    held = []
    q = queue.job_states(stream).writeStream.foreachBatch(lambda df, n: held.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["ticket"], r["state"], r["changes"]) for r in held} == {("a", "active", 2), ("b", "failed", 2)}
    gaps = []
    q = queue.idle_gaps(stream.withColumn("queue", F.lit("q")), "queue", "4 seconds", "1 second").writeStream.outputMode("append").foreachBatch(lambda df, n: gaps.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["tickets"] for r in sorted(gaps)] == [6]


def test_stacks_and_pending_work(spark, planes):
    from voxelloom.sources import volumes

    some = planes.where("z != 1")
    rows = {r["z"]: r["data"] for r in volumes.stack(some, 2, 3, Z, Y, X).collect()}
    assert len(rows) == Z and rows[1] == bytes(2 * Y * X) and rows[2] == ARRAY[2, 2, 3].tobytes()
    joined = volumes.concatenated([planes.where("t = 0"), planes.where("t = 1")])
    assert joined.agg(F.max("z")).first()[0] == 2 * Z - 1 and joined.count() == 2 * Z * C
    assert {(r["t"], r["c"]) for r in volumes.pending(planes.select("t", "c").distinct(), planes.where("t < 2"), ["t", "c"]).collect()} == {(2, c) for c in range(C)}


def test_volumes_are_read_by_kind(spark, planes, tmp_path):
    from voxelloom.sources import volumes

    tiff.write_series(model.volumes(planes), str(tmp_path / "s"))
    zarr.write_volumes(model.volumes(planes), str(tmp_path / "z"), "b")
    for rows in (volumes.read(spark, str(tmp_path / "s")), volumes.read(spark, str(tmp_path / "z"), "b")):
        assert (array_of(model.voxels(model.planes_of_volumes(rows)), *AXES) == ARRAY).all()


def test_pipeline_levels_and_projects(spark, planes):
    from voxelloom.functions import kernels as K

    psf = np.zeros((3, 3, 3))
    psf[1, 1, 1] = 1
    out = pipeline.level_volumes(model.volumes(planes), 1.0, 1.0, 45.0, psf, float(np.sin(np.pi / 4)), 2, background=0.0, z_end=2).where("t = 0 and c = 1").first()
    want = K.deskew_rotate(ARRAY[0, :, 1].astype(float), 45.0, np.sin(np.pi / 4))[:2]
    got = model.pixels(out["data"], out["dtype"], out["nz"], out["ny"], out["nx"])
    assert got.dtype == np.uint16 and np.abs(got - want).max() <= 1
    with pytest.raises(ValueError):
        pipeline.level_volumes(model.volumes(planes), 1.0, 1.0, 45.0, psf)


def test_command_line(spark, planes, tmp_path, capsys):
    from voxelloom import cli

    with pytest.raises(SystemExit):
        cli.parser().parse_args(["crop", "x", "--output", "y", "--top", "0-5,1:2"])
    assert cli.parser().parse_args(["crop", "x", "--output", "y", "--channels", "1, 2 3"]).channels == [1, 2, 3]
    zarr.write_volumes(model.volumes(planes), str(tmp_path), "b")
    assert cli.main(["consolidate", str(tmp_path), "b", "--xy", "0.1"]) == 0 and cli.main(["consolidate", str(tmp_path), "none", "--xy", "0.1"]) == 1
    assert "12 chunks linked" in capsys.readouterr().out


def test_pending_consolidations_and_side_outputs(spark, planes, tmp_path):
    folder = str(tmp_path / "d")
    zarr.write_volumes(model.volumes(planes), folder, "b")
    with open(os.path.join(folder, pipeline.SIDECAR), "w") as f:
        json.dump({"base_name": "b", "xy_pixel_um": 0.1, "t_interval_s": 1.0, "expected_zarrs": []}, f)
    broken = tmp_path / "e"
    broken.mkdir()
    (broken / pipeline.SIDECAR).write_text("{")
    assert pipeline.run_pending_consolidations(spark, [folder, str(broken), str(tmp_path)]) == {folder: T * C, str(broken): 0}
    assert pipeline.run_pending_consolidations(spark, [folder]) == {}
    notes = [json.loads(x) for x in open(os.path.join(folder, pipeline.CONSOLIDATION_LOG))]
    assert notes == [{"linked": T * C, "expected": 0, "missing": []}]
    assert "JSONDecodeError" in json.loads((broken / pipeline.CONSOLIDATION_LOG).read_text())["error"]
    with open(os.path.join(folder, pipeline.SIDECAR), "w") as f:
        json.dump({"base_name": "b", "xy_pixel_um": 0.1, "t_interval_s": 1.0, "expected_zarrs": ["b_T0000_C0.zarr", "b_T9999_C0.zarr"]}, f)
    results = spark.createDataFrame([("a.json", "completed"), ("b.json", "active")], "ticket string, state string")
    tickets = spark.createDataFrame([("a.json", folder), ("b.json", str(broken))], "ticket string, dataDir string")
    assert pipeline.consolidate_ended(spark, results, tickets) == {folder: T * C}
    assert json.loads(open(os.path.join(folder, pipeline.CONSOLIDATION_LOG)).readlines()[-1])["missing"] == ["b_T9999_C0.zarr"]
    assert pipeline.write_projections(model.volumes(planes), folder) == T * C
    flat = tiff.read_volumes(spark, os.path.join(folder, "MIPs")).where("t = 1 and c = 2").first()
    assert (model.pixels(flat["data"], flat["dtype"], 1, Y, X)[0] == ARRAY[1, :, 2].max(axis=0)).all()
    (tmp_path / "f").mkdir()
    for name in ("a.txt", "b.json", "c.tif"):
        (tmp_path / "f" / name).write_text(name)
    assert metadata.copy_sidecars(str(tmp_path / "f"), str(tmp_path / "g")) == ["a.txt", "b.json"] and metadata.copy_sidecars(str(tmp_path / "f"), str(tmp_path / "g")) == []


def test_tasks_of_a_scan_follow_bytes(spark, tmp_path):
    """A hundred thousand small planes are a few tasks, not one for each 64; few large ones are dealt to many."""
    for name, shape in (("small", [100, 50, 20, 8, 8]), ("large", [1, 64, 1, 2048, 2048])):
        (tmp_path / name).mkdir()
        (tmp_path / name / ".zarray").write_text(json.dumps(chunks.array_metadata(shape, [1, 1, 1, *shape[3:]], "<u2")))
    small, large = (chunks.scan(spark, str(tmp_path / name), missing="skip") for name in ("small", "large"))
    assert small.rdd.getNumPartitions() == 25 and small.count() == 0
    assert large.rdd.getNumPartitions() == 8 and large.where("z = 3").count() == 0


def test_tasks_of_pages_follow_bytes():
    """Small pages are few tasks, large ones many."""
    assert pages.tasks_for(102_560, 102_560 * 128) == 26 and pages.tasks_for(64, 64 << 23) == 8 and pages.tasks_for(0) == 1


def test_a_store_of_many_small_arrays_is_read_by_few_tasks(spark, tmp_path):
    """What is consolidated is read by tasks of bytes, not of 64 planes."""
    rows = spark.range(0, 16, 1, 2).selectExpr("'a' as dataset", "int(id div 2) as t", "int(id % 2) as c", "60 as nz", "2 as ny", "2 as nx", "'<u2' as dtype", "unhex(repeat('0100', 240)) as data")
    zarr.write_volumes(rows, str(tmp_path), "b")
    zarr.consolidate(spark, str(tmp_path), "b", 0.1, 2.0)
    found = zarr.read_planes(spark, str(tmp_path / "b.ome.zarr" / "0"))
    assert found.rdd.getNumPartitions() == 1 and found.count() == 16 * 60
