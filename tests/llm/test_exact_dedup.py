import hashlib
import os
from contextlib import suppress

from pyspark.sql import functions as F

from tierlake.llm.exact_dedup import DigestState, drop_duplicates, exact_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    norm = {r[0]: (r[1] or "").translate(LOWER) for r in rows}
    out = {}
    for doc_id, text in norm.items():
        group = [k for k, t in norm.items() if t == text]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out[doc_id] = (max(group), len(group), doc_id == max(group), sha)
    return out


def found(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_brute_force(docs, rows):
    assert found(exact_duplicates(docs)) == expected(rows)


def test_texts_under_one_digest_are_told_apart(docs, rows):
    short = exact_duplicates(docs, digest=lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1)))
    assert found(short) == expected(rows)


def test_repeated_rows_leave_one(twice, rows):
    result = exact_duplicates(twice).collect()
    assert len(result) == 2 * len(rows)
    stays = expected(rows)
    kept = [r for r in result if r.kept]
    assert len(kept) == len({s[3] for s in stays.values()})
    assert all(r.group_size == 2 * stays[r.doc_id][1] for r in result)


def test_dropping_keeps_all_columns(docs, twice, rows):
    want = sorted(k for k, v in expected(rows).items() if v[2])
    for table in (docs, twice):
        left = drop_duplicates(table)
        assert left.columns == table.columns
        assert sorted(r.doc_id for r in left.collect()) == want


def test_null_ids_and_empty_table(spark, nothing):
    table = spark.createDataFrame([(None, "x"), (3, "X"), (None, None)], "doc_id long, text string")
    result = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(table).collect()}
    assert result == {(None, 3, 2, False), (3, 3, 2, True), (None, None, 1, True)}
    assert exact_duplicates(nothing).collect() == []
    assert drop_duplicates(nothing).collect() == []


def test_state_outlives_deliveries(spark, docs, rows, tmp_path):
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    state = DigestState(spark, str(tmp_path))
    state.land(first)
    state.fold()
    state.land(second)
    # Another run, as after a restart: it goes on from the folder alone.
    later = DigestState(spark, str(tmp_path))
    later.fold()
    held = {(r.keep_id, r.group_size) for r in later.held().collect()}
    assert held == {(v[0], v[1]) for v in expected(rows).values()}
    assert later.held().where("locator is null").count() == 0


def test_state_is_closed_when_its_tasks_end(spark, docs, tmp_path):
    """RocksDB holds a LOCK file as long as a partition is open."""
    fds = f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/fd"

    def held():
        found = set()
        for name in os.listdir(fds):
            with suppress(OSError):  # closed meanwhile
                found.add(os.readlink(f"{fds}/{name}"))
        return found

    before = held()
    state = DigestState(spark, str(tmp_path))
    state.land(docs)
    state.fold()
    assert not [x for x in held() - before if x.endswith("/LOCK")]
    assert state.held().count() > 0


def test_plan_runs_no_python(docs):
    plan = exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
