import hashlib
import re
from collections import defaultdict

from helpers import ROWS, awkward
from paralane.llm.exact import ContentTable, exact_dedup, exact_groups


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        plain = re.sub("[\x20\x09-\x0d]", "", text or "")
        groups[plain].append((-len(text or ""), i is None, i or 0, i))
    return {plain: (min(g)[3], len(g)) for plain, g in groups.items()}


def check(spark, rows, **options):
    groups = expected(rows)
    by_hash = {hashlib.sha256(plain.encode()).hexdigest(): v for plain, v in groups.items()}
    found = exact_groups(awkward(spark, rows), **options).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["keep_id"], r["group_size"]) == by_hash[r["text_sha256"]]
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_groups_of_awkward_rows(spark):
    check(spark, ROWS)


def test_buckets_that_overflow_are_dealt_anew(spark):
    rows = [(i, f"text {i % 150} " * 20) for i in range(400)]
    check(spark, rows, budget=2000)


def test_rows_that_stay(spark):
    stay = exact_dedup(awkward(spark, ROWS))
    assert stay.columns == awkward(spark, []).columns
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in stay.collect())
    groups = expected(ROWS)
    assert [i for i, _ in texts] == sorted(i or -1 for i, _ in groups.values())
    assert (2, "alpha  beta gamma delta") in texts and (7, ROWS[6][1]) not in texts and (8, ROWS[7][1]) in texts


def test_no_rows(spark):
    assert exact_groups(awkward(spark, [])).count() == 0
    assert exact_dedup(awkward(spark, [])).count() == 0


def test_table_compares_contents():
    table = ContentTable()
    for content in (b"a", b"b"):  # one hash for both
        entry, slot = table.find(5, content)
        assert entry == -1
        table.add(slot, 5, content, (0,), (), 1, 1)
    assert table.find(5, b"a")[0] == 0 and table.find(5, b"b")[0] == 1 and table.find(5, b"c")[0] == -1
    for i in range(3000):
        content = str(i).encode()
        table.add(table.find(i * 7, content)[1], i * 7, content, (0,), (), 1, 1)
    assert all(table.find(i * 7, str(i).encode())[0] == i + 2 for i in range(3000))


def test_batches_are_closed_by_bytes():
    import pyarrow as pa

    from paralane.llm.common import batches_of

    schema = pa.schema([("text", pa.string()), ("data", pa.binary()), ("n", pa.int64())])
    rows = [("x" * 3_000_000, None, i) for i in range(60)] + [(None, b"y" * 3_000_000, i) for i in range(60)] + [(None, None, i) for i in range(50)]
    batches = list(batches_of(iter(rows), schema, 40))
    assert [n for b in batches for n in b.column("n").to_pylist()] == [n for _, _, n in rows]
    assert max(b.nbytes for b in batches) < 70_000_000 and max(b.num_rows for b in batches) == 40
