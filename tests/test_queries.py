"""Every registered query of the array engine against its SQL twin, and the entry point without the optional subpackage."""

import math
import os
import re
import shutil
import subprocess
import sys
import tempfile

import duckdb
import numpy as np
import pytest

from tests.conftest import ROOT, SMALL
from voxelloom.functions import kernels as K
from voxelloom.plans import kernels, registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SMALL)
    rel = con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str(tuple(_plain(r[names.index(c)]) for c in df.columns)) for r in rel.fetchall())
    assert sorted(str(tuple(map(_plain, r))) for r in df.collect()) == want


def _stacks() -> dict:
    """The table's stacks as plain numpy, by (t, c)."""
    import pyarrow.parquet as pq

    held: dict = {}
    for r in pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist():
        plane = np.floor((np.array(r["embedding"], np.float32).astype(float) + 1) * 1000).astype("<u2").reshape(8, 8)
        held.setdefault((r["vec_id"] // 50, r["label"]), {})[r["vec_id"] % 50] = plane
    return {k: np.stack([v.get(z, np.zeros((8, 8), "<u2")) for z in range(max(v) + 1)]) for k, v in held.items()}


def _whole(v):
    return np.clip(np.floor(v + 0.5), 0, 65535).astype("<u2")


_BY_VOLUME = {
    "rl_decon": lambda v: K.richardson_lucy(v, kernels.toy_psf(), 5, background=100),
    "deskew_rotate": lambda v: K.deskew_rotate(v, 60.0, 1.2),
    "isolate_bead": K.isolate_bead,
    "auto_mask": lambda v: K.auto_mask(v).astype("u1"),
    "bead_extract": lambda v: K.extract_bead(v, tuple(n // 2 for n in v.shape), (2, 2, 2)),
}


@pytest.mark.parametrize("name", sorted(_BY_VOLUME))
def test_kernel_query_equals_numpy(spark, name):
    made = {k: x for k, v in _stacks().items() if (x := _BY_VOLUME[name](v)) is not None}
    got = {(r["t"], r["c"]): r for r in registry.QUERIES[name](spark, SMALL).collect()}
    assert set(got) == set(made) and got
    for k, x in made.items():
        r = got[k]
        assert (r["nz"], r["ny"], r["nx"]) == x.shape
        assert r["total"] == pytest.approx(float(x.sum(dtype=float)), rel=1e-6, abs=1e-2) and r["top"] == pytest.approx(float(x.max()), rel=1e-6, abs=1e-2)


def test_other_kernel_queries_equal_numpy(spark):
    stacks, run = _stacks(), lambda name: registry.QUERIES[name](spark, SMALL).collect()
    want = {}
    for (t, c), v in stacks.items():
        top = _whole(K.deskew_rotate(K.richardson_lucy(v, kernels.toy_psf(), 2, background=100), 60.0, 1.2)).max(axis=0)
        want |= {(t, c, y, x): int(n) for (y, x), n in np.ndenumerate(top)}
    assert {(r["t"], r["c"], r["y"], r["x"]): int(r["v"]) for r in run("decon_then_deskew")} == want
    rows = {(r["t"], r["z"], r["c"]): r["fwhm"] for r in run("gaussian_fwhm")}
    assert all(rows[(t, z, c)] == pytest.approx(K.gaussian_fwhm(v[z][4]), abs=1e-3) for (t, c), v in stacks.items() for z in range(len(v)) if v[z].any())
    moved = {(r["t"], r["c"]): r for r in run("align_shift")}
    for k, v in stacks.items():
        roi, dy, dx = K.align_rois(v.max(axis=0), (0, 4, 0, 8), (4, 8, 0, 8))
        assert (tuple(moved[k]["roi"]), moved[k]["dy"], moved[k]["dx"]) == (tuple(map(int, roi)), round(dy, 3), round(dx, 3))
    beads = {r["c"]: r for r in run("psf_average")}
    for c in {c for _, c in stacks}:
        own = [v for (_, k), v in sorted(stacks.items()) if k == c]
        canvas = tuple(n + 1 - n % 2 for n in np.max([v.shape for v in own], axis=0))
        aligned = [x for v in own if (x := K.aligned_bead(v, None, canvas, 0.1, True, "library")) is not None]
        psf = K.finished_psf(sum(aligned) / len(aligned), 0.1)
        assert beads[c]["total"] == pytest.approx(float(psf.sum()), rel=1e-4) and (beads[c]["nz"], beads[c]["ny"], beads[c]["nx"]) == psf.shape


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_folders(tmp_path):
    shutil.copytree(os.path.join(ROOT, "voxelloom"), tmp_path / "voxelloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op') and n[2:3].isdigit() for n in q), q; assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def _equals_sql_over(spark, name: str, **tables) -> list:
    """A query's rows over hand-made (rows, schema) tables, held against its SQL over the same."""
    folder = tempfile.mkdtemp()
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    df, rel = registry.QUERIES[name](spark, folder), con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == sorted(df.columns)
    found = df.collect()
    assert sorted(str(tuple(map(_plain, r))) for r in found) == sorted(str(tuple(_plain(r[names.index(c)]) for c in df.columns)) for r in rel.fetchall())
    return found


def test_iteration_errors_over_a_first_error_of_zero(spark):
    values = {1: [0.0, 2.0, -3.0, 0.0, None], 2: [-0.0, 1.5, 4.0], 3: [4.0, 2.0, 0.0], 4: [None, 1.0], 5: [float("nan"), 1.0]}
    rows = [(10 * user + k, user, v) for user, found in values.items() for k, v in enumerate(found)]
    found = {(r["user_id"], r["k"]): r["ratio"] for r in _equals_sql_over(spark, "iteration_errors", events=(rows, "event_id long, user_id long, value double"))}
    assert (found[1, 2], found[1, 3], found[2, 2], found[3, 2], found[1, 5]) == (math.inf, -math.inf, -math.inf, 0.5, None)
    assert math.isnan(found[1, 1]) and math.isnan(found[1, 4])


def test_iteration_errors_round_halves_as_their_sql(spark):
    """Halves of the seventh digit, of which the first three are in sf0.1; then zeros below 0, and what overflows a million times over."""
    values = {1: [16.0, 28.68, 169.69], 2: [16.0, 66.81, 120.44], 3: [2.56, 152.77, 99.29], 4: [1.0, *((10 * k + 5) / 1e7 for k in range(200))], 5: [-1.0, *((10 * k + 5) / 1e7 for k in range(200))]}
    values |= {6: [-4.0, 0.0, 1e-7, -1e-7], 7: [1.0, 1e303, -1.7e308, 0.49999999999999994e-6]}
    rows = [(1000 * user + k, user, v) for user, found in values.items() for k, v in enumerate(found)]
    found = {(r["user_id"], r["k"]): (r["ratio"], r["change"]) for r in _equals_sql_over(spark, "iteration_errors", events=(rows, "event_id long, user_id long, value double"))}
    assert (found[1, 3][1], found[2, 3][1], found[3, 3][1]) == (0.881313, 0.335188, 2.089062)
    assert math.copysign(1, found[6, 2][0]) == -1 and found[7, 2][0] == 1e303


def test_tables_numbers_round_halves_as_their_sql(spark):
    """Three digits of seconds, four of a job's sum, six of a supplier's share of its range."""
    rows = [(k, k, "read", (10 * k + 5) / 1e4) for k in range(1000)]
    schema = "event_id long, user_id long, event_type string, value double"
    found = {r["event_id"]: r["seconds"] for r in _equals_sql_over(spark, "parse_seconds", events=(rows, schema))}
    assert (found[501], found[500]) == (0.501, 0.0)
    rows = [(6 * k, k, "read", (10 * n + 5) / 1e5) for k, n in enumerate((1, 14, 46, 56, 81, 84, 104, 107, 124, 127, 160, 177, 194, 200, 217, 223, 240, 246, 323, 340))]
    assert len(_equals_sql_over(spark, "profile_report", events=(rows, schema))) == 20
    rows = [(k, 1, 1, 1, v) for k, v in enumerate([0.0, 1.0, *((10 * k + 5) / 1e7 for k in range(400))])]
    assert len(_equals_sql_over(spark, "minmax_unit", lineitem=(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"))) == 402


def test_pixel_shares_round_halves_as_their_sql(spark):
    """Of a sum of 5,120 x 2^k, shares end on halves of the tenth digit."""
    rows = []
    for t, whole in enumerate((5120, 10240, 20480)):
        pixels = [(7 * k + t) % 61 + 1 for k in range(63)]
        pixels.append(whole - sum(pixels))
        rows.append((50 * t, [(v + 0.5) / 1000 - 1 for v in pixels], 0))
    found = _equals_sql_over(spark, "psf_normalise", embeddings=(rows, "vec_id long, embedding array<float>, label int"))
    assert len(found) == 3 * 64


def test_blend_alpha_of_every_slice(spark):
    rows = [(50 * t + z, [float((7 * k + 13 * c + z + t) % 19) / 10 - 0.9 for k in range(64)], c) for t in range(2) for z in range(3) for c in range(3)]
    found = _equals_sql_over(spark, "blend_alpha", embeddings=(rows, "vec_id long, embedding array<float>, label int"))
    assert len(found) == 2 * 3 * 64 and {(r["t"], r["z"]) for r in found} == {(t, z) for t in range(2) for z in range(3)}


def test_decon_then_deskew_is_one_python_pass_over_stacks(spark):
    """No volume that the kernel made goes from worker to worker."""
    plan = registry.QUERIES["decon_then_deskew"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("name, workers", [("decon_then_deskew", 1), ("deskew_only", 1), ("rl_decon", 2), ("deskew_rotate", 2), ("isolate_bead", 2), ("auto_mask", 2)])
def test_stacks_meet_their_kernel_in_one_worker(spark, name, workers):
    """A task has no worker that only stacks planes; the second one sums volumes."""
    plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\b(?:FlatMapGroups|Map)In(?:Pandas|Arrow)\b", plan)) == workers
