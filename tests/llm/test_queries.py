"""Every registered query of the operators against brute force, on driver tables and hostile rows."""

from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cohortlens.llm import queries as registered
from cohortlens.llm.html_extraction import blocks, is_main
from tests.llm import brute, cases

FOLDER = "/root/testdata/sf0.001"
ITEMS = [
    ("7", cases.PASSAGE), ("7", "two words"), ("11", None), ("b", ""), (None, "a b"),
    ("9", "KALA " * 3 + "tola"), ("c", " ".join(f"passage{n}" for n in range(40, 55))),
]

BRUTE = {
    "op1_token_files": brute.token_files,
    "op2_near_dedup": brute.near_groups,
    "op4_window_dedup": brute.remove_windows,
    "op7_token_counts": brute.token_counts,
    "op8_byte_bpe": brute.byte_bpe,
    "op9_quality_rules": brute.quality_counts,
    "op10_suffix_dedup": brute.remove_bytes,
}


def read(path, *columns):
    table = pq.read_table(path, columns=list(columns))
    return list(zip(*[table.column(name).to_pylist() for name in columns]))


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    """The driver's smallest tables, hostile rows, and empty tables."""
    hostile = tmp_path_factory.mktemp("hostile")
    docs = cases.hostile()
    ids, texts = map(list, zip(*docs))
    extra = {"lang": ["xx"] * len(ids), "source": ["s"] * len(ids), "n_chars": [len(t or "") for t in texts]}
    types = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
    table = pa.table({"doc_id": ids, "text": texts} | extra, schema=pa.schema(list(types.items())))
    items = pa.table(
        {"item_id": [i for i, _ in ITEMS], "text": [t for _, t in ITEMS]},
        schema=pa.schema([("item_id", pa.string()), ("text", pa.string())]),
    )
    pages = pa.table(
        {"page_id": [1, 2, 3], "url": ["u", None, "w"], "html": [None, "", "<p>&amp; x <b>y</b>z"]},
        schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
    )
    empty = tmp_path_factory.mktemp("empty")
    for name, rows in (("documents", table), ("benchmark", items), ("pages", pages)):
        pq.write_table(rows, hostile / f"{name}.parquet")
        pq.write_table(rows.slice(0, 0), empty / f"{name}.parquet")
    found = {"hostile": str(hostile), "empty": str(empty)}
    return found | ({"driver": FOLDER} if Path(FOLDER).exists() else {})


@pytest.mark.parametrize("where", ["driver", "hostile", "empty"])
@pytest.mark.parametrize("name", BRUTE)
def test_query_equals_brute_force(spark, folders, name, where):
    if where not in folders:
        pytest.skip("needs the driver tables")
    folder = folders[where]
    wanted = BRUTE[name](read(f"{folder}/documents.parquet", "doc_id", "text"))
    found = cases.results(registered.queries()[name](spark, folder))
    width = len(next(iter(wanted.values()), ()))
    assert {key: row[:width] for key, row in found.items()} == wanted


@pytest.mark.parametrize("where", ["driver", "hostile", "empty"])
def test_passages_equal_brute_force(spark, folders, where):
    if where not in folders:
        pytest.skip("needs the driver tables")
    folder = folders[where]
    docs = read(f"{folder}/documents.parquet", "doc_id", "text")
    items = [row for row in read(f"{folder}/benchmark.parquet", "item_id", "text")]
    wanted = brute.passages(docs, [row for row in items if row[0] is not None])
    found = cases.results(registered.op3_decontamination(spark, folder))
    assert {key: row[0] for key, row in found.items()} == {key: row[0] for key, row in wanted.items()}
    named = {key for key, row in wanted.items() if row[2]}
    assert {key for key, row in found.items() if row[2]} == named
    assert all(found[key] == wanted[key] for key in named)


@pytest.mark.parametrize("where", ["driver", "hostile", "empty"])
def test_shards_hold_every_row_once(spark, folders, where):
    if where not in folders:
        pytest.skip("needs the driver tables")
    folder = folders[where]
    docs = dict(read(f"{folder}/documents.parquet", "doc_id", "text"))
    rows = registered.op5_sharding(spark, folder).collect()
    assert {row["doc_id"] for row in rows} == set(docs) and len(rows) == len(docs)
    slots = {}
    for row in rows:
        assert row["size"] == len(brute.raw(docs[row["doc_id"]])) + 8
        assert row["text_crc32"] == brute.zlib.crc32(brute.raw(docs[row["doc_id"]]))
        assert row["law"] == "rows" and row["grown_shard"] is None and 0 <= row["shard"] < 24
        slots.setdefault(row["shard"], []).append(row["slot"])
    counts = [len(slots.get(shard, ())) for shard in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


@pytest.mark.parametrize("where", ["driver", "hostile", "empty"])
def test_pages_give_their_main_blocks(spark, folders, where):
    if where not in folders:
        pytest.skip("needs the driver tables")
    folder = folders[where]
    pages = read(f"{folder}/pages.parquet", "page_id", "html")
    found = cases.results(registered.op6_html_extraction(spark, folder), "page_id")
    assert set(found) == {page_id for page_id, _ in pages}
    assert all(row[2] == len(row[1]) for row in found.values())
    if where == "driver":
        wanted = {
            page_id: " ".join(block.text for block in blocks(html) if is_main(block))
            for page_id, html in pages
        }
        same = sum(found[page_id][1] == text for page_id, text in wanted.items())
        assert same >= 0.98 * len(wanted)
    elif where == "hostile":
        assert found[1][1] == "" and found[2][1] == ""


# --- DuckDB SQL ---------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, folders, name):
    if "driver" not in folders:
        pytest.skip("needs the driver tables")
    with duckdb.connect() as engine:
        for table in ("documents", "benchmark", "embeddings", "conversations"):
            engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        result = engine.execute(registered.oracle_sql()[name])
        columns = [item[0] for item in result.description]
        wanted = sorted(map(repr, result.fetchall()))
    found = registered.queries()[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    rows = found.select(*columns).collect()
    assert sorted(repr(tuple(row)) for row in rows) == wanted
