"""Header handling, dialect, atomic batches, row numbers and stored tables."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sluiceway.functions.payload import value_of
from sluiceway.functions.scalars import blank_to_null, row_hash
from sluiceway.operators.profile import load_profile
from sluiceway.functions.metrics import Check
from sluiceway.operators.audit import AuditLog
from sluiceway.sources import rowlog
from sluiceway.sources.rowlog import RowLog
from sluiceway.operators.upsert import merge_into
from sluiceway.operators.verdict import judge, verdicts
from sluiceway.plans import transactions as tx
from sluiceway.session import scoped_conf
from sluiceway.sources.headers import BadHeader, describe_headers, header_groups, line_scans
from sluiceway.sources.listing import list_files, pending_files
from sluiceway.sources.loading import BatchInUse, FilesDiffer, load_csv, load_parquet, read_csv_inferred
from sluiceway.sources.mirror import MIRROR_SCHEMA, open_mirror
from sluiceway.sources.samples import sample_accounts, sample_transactions
from sluiceway.sources.tables import PartTable
from sluiceway.sources.unload import unload_csv, unload_parquet
from sluiceway.streaming import gates as stream_gates
from sluiceway.streaming.gates import KeyRuns


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


HEADERS = [
    ("A,B,C", ["A", "B", "C"], None),
    (' "A" , B,"C, d"', ["A", "B", "C, d"], None),
    ('"say ""x""",B', ['say "x"', "B"], None),
    ("\ufeffA,B", ["A", "B"], None),
    ("a,A", ["a", "A"], None),
    ("A,,C", ["A", "", "C"], "empty column name"),
    ("A,B,", ["A", "B", ""], "empty column name"),
    ("A,B,A", ["A", "B", "A"], "duplicate column name"),
    ('A,"B', None, "unbalanced quote"),
    ('a"b"c,D', None, "stray quote"),
    ("", None, "no header row"),
    (",".join(f"c{i}" for i in range(199)), [f"c{i}" for i in range(199)], None),
    (",".join(f"c{i}" for i in range(200)), [f"c{i}" for i in range(200)], None),
]


def test_header_lines(spark):
    lines = spark.createDataFrame([(i, h) for i, (h, _, _) in enumerate(HEADERS)], "i int, line string")
    for r in describe_headers(lines).collect():
        _, names, problem = HEADERS[r.i]
        assert r.problem == problem
        assert names is None or r["names"] == names


def test_fingerprint_depends_on_order(spark):
    lines = spark.createDataFrame([("A,B",), ("B,A",), ('"A","B"',)], "line string")
    a, b, quoted = [r.fingerprint for r in describe_headers(lines).collect()]
    assert a != b and a == quoted and len(a) == 12


def test_first_lines_of_many_files(spark, folder):
    files = [put(folder, f"f {i}+.csv", f"A,B{i % 3}\n" + "1,2\n" * 5000) for i in range(20)]
    found = {os.path.basename(r.file): r.line for r in lines_of(spark, files)}
    assert found == {f"f {i}+.csv": f"A,B{i % 3}" for i in range(20)}
    assert sorted(len(members) for _, _, members in header_groups(spark, files)) == [6, 7, 7]


def lines_of(spark, files):
    rows = []
    for settings, lines in line_scans(spark, files):
        with scoped_conf(spark, settings):
            rows += lines.collect()
    return rows


def test_headers_of_many_small_files_take_a_task_per_core(spark, folder, monkeypatch):
    files = [put(folder, f"in/{i}.csv", f"A,B{i % 2}\n1,2\n") for i in range(300)]
    (settings, lines), = line_scans(spark, files)
    with scoped_conf(spark, settings):
        assert lines.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert {len(m) for _, _, m in header_groups(spark, files)} == {150}
    # Large files go by themselves; empty ones have no line.
    monkeypatch.setattr("sluiceway.sources.headers.SMALL_FILE_BYTES", 100)
    files[:3] = [put(folder, f"in/big{i}.csv", "A,B0\n" + "1,2\n" * 1000) for i in range(3)]
    assert len(line_scans(spark, files)) == 2
    assert sorted(len(m) for _, _, m in header_groups(spark, files)) == [149, 151]
    with pytest.raises(BadHeader, match="no header row in 1 of 301 files"):
        header_groups(spark, [*files, put(folder, "in/none.csv", "")])


ODD_NAMES = ["a[1]", "a1", "{n}", "n", "x*y", "xzy", "q?", "qq", "b c", "p%41", "pA", "pl+us", "co,ma", "back\\slash", "ü é"]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_files_are_read_by_their_exact_names(spark, folder, kind):
    files = []
    for i, name in enumerate(ODD_NAMES):
        path = f"{folder}/in [0-9]/{name}.{kind}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if kind == "csv":
            put(folder, f"in [0-9]/{name}.csv", "K\n" + f"{i}\n" * (i + 1))
        else:
            pq.write_table(pa.table({"K": [i] * (i + 1)}), path)
        files.append(path)
    mirror, landing = open_mirror(spark, f"{folder}/mirror"), f"{folder}/in [0-9]"
    load = {"parquet": load_parquet, "csv": load_csv}[kind]
    for some in (files[:1], files[1:]):
        load(spark, mirror, some, base=landing)
    rows = mirror.read().select("_FILENAME", value_of("K", "int").alias("k")).groupBy("_FILENAME", "k").count().collect()
    assert {(r._FILENAME, r.k, r["count"]) for r in rows} == {(f"{n}.{kind}", i, i + 1) for i, n in enumerate(ODD_NAMES)}
    assert pending_files(spark, landing, mirror) == []


def test_rows_of_files_that_were_not_given_are_kept_out(spark, folder, monkeypatch):
    """Were a path taken for a pattern again, the load would fail instead of loading other files."""
    monkeypatch.setattr("sluiceway.sources.loading.literal", lambda path: path)
    for name in ["b[1]", "b1"]:
        os.makedirs(f"{folder}/in", exist_ok=True)
        pq.write_table(pa.table({"K": [1, 2]}), f"{folder}/in/{name}.parquet")
    mirror = open_mirror(spark, f"{folder}/mirror")
    with pytest.raises(FilesDiffer, match="b1.parquet"):
        load_parquet(spark, mirror, [f"{folder}/in/b[1].parquet"])
    assert mirror.is_empty()


def test_wide_whole_numbers_keep_their_digits(spark, folder):
    big, wider, widest = "9223372036854775806", "12345678901234567890", "1" * 39
    header = "A,B,C,D,E,F\n"
    rows = f"{big},{wider},{widest},{big},0.5,+7\n-1,1,1,1.5,2,-007\n"
    back = read_csv_inferred(spark, [put(folder, "w.csv", header + rows)])
    assert dict(back.dtypes) == {"A": "bigint", "B": "decimal(38,0)", "C": "string", "D": "string", "E": "double", "F": "bigint"}
    assert {str(r.A) for r in back.collect()} == {big, "-1"} and {str(r.B) for r in back.collect()} == {wider, "1"}
    assert {r.C for r in back.collect()} == {widest, "1"} and {r.D for r in back.collect()} == {big, "1.5"}


def test_null_tokens(spark):
    texts = ["NULL", "", "  ", "N/A", "n/a", "\\N", " NULL ", "null", " x ", "0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(blank_to_null(F.col("t")).alias("t"))
    assert [r.t for r in rows.collect()] == [None] * 7 + ["null", "x", "0"]


def test_reordered_columns_are_keyed_by_name(spark, folder):
    rows = sample_transactions(spark, 300, "2024-03-01")
    unload_csv(rows, f"{folder}/in/normal", single_file=True)
    unload_csv(rows.select(*reversed(tx.KEYS)), f"{folder}/in/reordered", single_file=True)
    mirror = open_mirror(spark, f"{folder}/mirror")
    got = load_csv(spark, mirror, pending_files(spark, f"{folder}/in", mirror, "*.csv"), base=f"{folder}/in")
    assert (got.status, got.headers, got.files, got.rows) == ("LOADED", 2, 2, 600)
    loaded = mirror.read()
    assert loaded.schema.names == MIRROR_SCHEMA.names and len(loaded.schema) == 22
    per_row = loaded.groupBy("ROW_HASH_ID").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_SCHEMA_FP").alias("fp"),
        F.count_distinct(F.to_json("RAW_DATA")).alias("payloads"),
    )
    assert {tuple(r)[1:] for r in per_row.collect()} == {(2, 2, 1)}
    back = tx.mirror_keys(loaded).select(*tx.KEYS).distinct()
    assert back.exceptAll(rows).count() == 0 and back.count() == 300
    same = loaded.where("_FILENAME = PROVIDER_FILE_NM and _FILE_ROW_NUM = FILE_RECORD_NBR and CREATED_DTS = UPDATED_DTS")
    assert same.count() == 600


@pytest.mark.parametrize("multi_line", [False, True])
def test_row_numbers_over_many_blocks(spark, folder, multi_line):
    files = [put(folder, f"in/{n}.csv", "K,V\n" + "".join(f"{i},{'x' * (i % 40)}\n" for i in range(1, n + 1)))
             for n in (1, 700, 5000)]
    mirror = open_mirror(spark, f"{folder}/mirror")
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": "4096"}):
        load_csv(spark, mirror, files, multi_line=multi_line)
        rows = mirror.read().select(value_of("K", "bigint").alias("k"), "_FILE_ROW_NUM", "_FILENAME")
        assert rows.where("k <> _FILE_ROW_NUM or _FILE_ROW_NUM is null").count() == 0
    assert rows.count() == 5701


def test_ragged_quoted_and_null_fields(spark, folder):
    file = put(folder, "r.csv", 'A,B,C\n1,2\n1,2,3,4\n"x, y","say ""hi""",N/A\n NULL , b ,\n')
    mirror = open_mirror(spark, f"{folder}/mirror")
    load_csv(spark, mirror, [file], metadata={"BUSINESS_KEY": "A"})
    got = mirror.read().orderBy("_FILE_ROW_NUM").select(*[value_of(c).alias(c) for c in "ABC"]).collect()
    assert [tuple(r) for r in got] == [("1", "2", None), ("1", "2", "3"), ("x, y", 'say "hi"', None), (None, "b", None)]
    assert mirror.read().select("UNIQUE_HASH_ID").distinct().count() == 3


def test_bad_header_fails_whole_batch(spark, folder):
    good, bad = put(folder, "in/good.csv", "A,B\n1,2\n"), put(folder, "in/empty_header.csv", "A,,B\n1,X,2\n")
    mirror = open_mirror(spark, f"{folder}/mirror")
    with pytest.raises(BadHeader, match="empty column name"):
        load_csv(spark, mirror, [good, bad])
    assert mirror.read().count() == 0
    os.remove(bad)
    assert load_csv(spark, mirror, pending_files(spark, f"{folder}/in", mirror)).rows == 1
    with pytest.raises(BadHeader, match="no header row"):
        load_csv(spark, mirror, [put(folder, "in/nothing.csv", "")])


def test_file_list_guards(spark, folder):
    mirror = open_mirror(spark, f"{folder}/mirror")
    for load in (load_csv, load_parquet):
        with pytest.raises(ValueError):
            load(spark, mirror, None)
        assert load(spark, mirror, []).status == "EMPTY"


def test_corrupt_file_fails_batch_and_retry_works(spark, folder):
    landing, mirror = f"{folder}/in", open_mirror(spark, f"{folder}/mirror")
    unload_parquet(sample_transactions(spark, 3000, "2024-03-01").repartition(2), f"{landing}/good", 400)
    first = pending_files(spark, landing, mirror, "*.parquet")
    assert len(first) > 4
    assert load_parquet(spark, mirror, first, {"BATCH_ID": "one"}, base=landing).rows == 3000
    assert pending_files(spark, landing, mirror, "*.parquet") == []
    profile = load_profile(mirror.read()).first()
    assert profile.distinct_row_hash == 3000 and profile.distinct_unique_hash == profile.files == len(first)
    unload_parquet(sample_transactions(spark, 2000, "2024-03-01", 5000), f"{landing}/good2", 400)
    broken = put(landing, "corrupt.parquet", "this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        load_parquet(spark, mirror, pending_files(spark, landing, mirror, "*.parquet"), {"BATCH_ID": "two"}, base=landing)
    assert mirror.read().count() == 3000
    os.remove(broken)
    again = pending_files(spark, landing, mirror, "*.parquet")
    assert load_parquet(spark, mirror, again, {"BATCH_ID": "two"}, base=landing).rows == 2000
    assert {r["_BATCH_ID"]: r["count"] for r in mirror.read().groupBy("_BATCH_ID").count().collect()} == {
        "one": 3000, "two": 2000,
    }
    numbers = mirror.read().groupBy("_FILENAME").agg(F.min("_FILE_ROW_NUM").alias("lo"), F.max("_FILE_ROW_NUM").alias("hi"),
                                                    F.count(F.lit(1)).alias("n"))
    assert numbers.where("lo <> 1 or hi <> n").count() == 0


def test_row_hash_ignores_order_and_absent_columns(spark):
    one = spark.createDataFrame([("1", None, "x")], "a string, b string, c string")
    hashes = {
        frame.select(row_hash({n: F.col(n) for n in frame.columns})).first()[0]
        for frame in (one, one.select("c", "a", "b"), one.drop("b"))
    }
    assert len(hashes) == 1


def test_unload_limits_file_size(spark, folder):
    unload_parquet(spark.range(1000).coalesce(1), f"{folder}/p", 300)
    assert list_files(spark, f"{folder}/p", "*.parquet").count() == 4
    unload_csv(spark.range(10).select("id", (F.col("id") / 2).alias("half")), f"{folder}/c", single_file=True)
    back = read_csv_inferred(spark, [r.path for r in list_files(spark, f"{folder}/c", "*.csv").collect()])
    assert back.dtypes == [("id", "bigint"), ("half", "double")] and back.count() == 10


# ---- stored tables ----------------------------------------------------------


@pytest.fixture()
def table(spark, folder):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 3, 0), ("c", 4, 0)], "p string, k int, v int")
    stored = PartTable(spark, f"{folder}/t", rows.schema, "p")
    stored.replace(rows)
    return stored


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_unpublished_rows_are_invisible(spark, table):
    before = content(table)
    table.write(spark.createDataFrame([("d", 9, 9)], "p string, k int, v int"))
    assert content(table) == before
    with pytest.raises(RuntimeError):
        table.replace(spark.createDataFrame([("a", 9, 9)], table.schema), verify=_stop)
    assert content(table) == before


def _stop():
    raise RuntimeError("checked and refused")


def test_replace_drop_and_delete(spark, table):
    table.replace(spark.createDataFrame([("a", 9, 9)], table.schema), drop=["b"])
    assert content(table) == [("a", 9, 9), ("c", 4, 0)]
    assert table.delete_where(F.col("k") == 4) == ["c"]
    assert content(table) == [("a", 9, 9)]
    assert table.delete_where(F.col("k") == 4) == []
    assert not table.seed(spark.createDataFrame([("z", 0, 0)], table.schema))


@pytest.mark.parametrize(
    ("new", "rewritten", "want"),
    [
        ([("n", 7, 1)], [], [("a", 1, 0), ("a", 2, 0), ("b", 3, 0), ("c", 4, 0), ("n", 7, 1)]),
        ([("n", 1, 1), ("n", 8, 1)], ["a"], [("a", 2, 0), ("b", 3, 0), ("c", 4, 0), ("n", 1, 1), ("n", 8, 1)]),
        ([("n", 3, 1)], ["b"], [("a", 1, 0), ("a", 2, 0), ("c", 4, 0), ("n", 3, 1)]),
        ([("a", 1, 5), ("c", 3, 5)], ["a", "b", "c"], [("a", 1, 5), ("a", 2, 0), ("c", 3, 5), ("c", 4, 0)]),
        ([("n", 1, 1), ("n", 1, 2)], ["a"], [("a", 2, 0), ("b", 3, 0), ("c", 4, 0), ("n", 1, 2)]),
        ([], None, [("a", 1, 0), ("a", 2, 0), ("b", 3, 0), ("c", 4, 0)]),
    ],
)
def test_merge(spark, table, new, rewritten, want):
    untouched = table.live_parts()
    source = spark.createDataFrame(new, table.schema)
    for _ in range(2):
        merged = merge_into(table, source, ["k"], [F.desc("v")])
        assert content(table) == want
        if rewritten is not None and _ == 0:
            assert merged.rewritten == rewritten
            now = table.live_parts()
            assert all(now[p] == v for p, v in untouched.items() if p not in rewritten)


def test_columns_added_later_are_null(spark, folder):
    accounts = sample_accounts(spark, 5)
    PartTable(spark, folder + "/t", accounts.drop("ACCOUNT_NAME").schema, "ACCOUNT_TYPE").replace(accounts.drop("ACCOUNT_NAME"))
    assert PartTable(spark, folder + "/t", accounts.schema, "ACCOUNT_TYPE").read().where("ACCOUNT_NAME is null").count() == 5


def test_samples_are_repeatable(spark):
    a, b = sample_transactions(spark, 50, "2024-03-01"), sample_transactions(spark, 20, "2024-03-01", 30)
    assert b.exceptAll(a).count() == 0 and a.select("TXN_ID").distinct().count() == 50


def rows_as_text(mirror):
    return sorted(r[0] for r in mirror.read().select(F.to_json("RAW_DATA")).collect())


def test_headers_that_join_alike_and_wide_headers(spark, folder):
    mirror = open_mirror(spark, folder + "/m")
    wide = [f"c{i}" for i in range(250)]
    files = [
        put(folder, "in/a.csv", '"a,b",c\n1,2\n'), put(folder, "in/b.csv", "a,b,c\n7,8,9\n"),
        put(folder, "in/c.csv", ",".join(wide) + "\n" + ",".join("1" for _ in wide) + "\n"),
        put(folder, "in/d.csv", 'a,b\n" x ", y \n'),
    ]
    found = load_csv(spark, mirror, files, {"BATCH_ID": "x"})
    assert (found.headers, found.files, found.rows) == (4, 4, 4)
    texts = rows_as_text(mirror)
    assert {'{"a":"7","b":"8","c":"9"}', '{"a,b":"1","c":"2"}', '{"a":" x ","b":"y"}'} < set(texts)
    assert max(map(len, texts)) > 250 * 5


def test_files_without_rows_are_logged(spark, folder):
    mirror = open_mirror(spark, folder + "/m")
    files = [put(folder, "in/full.csv", "a\n1\n"), put(folder, "in/empty.csv", "a\n")]
    found = load_csv(spark, mirror, files, {"BATCH_ID": "x"}, base=f"{folder}/in")
    assert (found.files, found.rows) == (2, 1)
    assert {(r.item, r.rows) for r in mirror.items().collect()} == {("full.csv", 1), ("empty.csv", 0)}
    assert pending_files(spark, f"{folder}/in", mirror) == []
    only = put(folder, "in/header.csv", "a\n")
    assert load_csv(spark, mirror, [only], {"BATCH_ID": "y"}, base=f"{folder}/in").rows == 0
    assert pending_files(spark, f"{folder}/in", mirror) == [] and mirror.read().count() == 1


def test_a_used_batch_id_adds_or_retries_but_never_replaces(spark, folder):
    mirror, base = open_mirror(spark, folder + "/m"), f"{folder}/in"
    one, two = put(base, "one.csv", "a\n1\n"), put(base, "two.csv", "a\n2\n")
    go = lambda *files: load_csv(spark, mirror, list(files), {"BATCH_ID": "x"}, base=base)
    go(one)
    go(two)
    assert rows_as_text(mirror) == ['{"a":"1"}', '{"a":"2"}']
    put(base, "two.csv", "a\n2\n3\n")
    go(two)
    assert rows_as_text(mirror) == ['{"a":"1"}', '{"a":"2"}', '{"a":"3"}']
    with pytest.raises(BatchInUse):
        go(two, put(base, "three.csv", "a\n4\n"))
    go(one, two)
    assert len(rows_as_text(mirror)) == 3 and pending_files(spark, base, mirror) == [f"file:{base}/three.csv"]


def test_many_publishes_leave_a_small_log(spark, folder, monkeypatch):
    monkeypatch.setattr("sluiceway.sources.tables.SNAPSHOT_EVERY", 4)
    table = PartTable(spark, folder + "/t", spark.createDataFrame([], "p string, k int").schema, part="p")
    table.replace(spark.createDataFrame([("a", 0), ("b", 0)], table.schema))
    sizes = []
    for i in range(1, 26):
        table.replace(spark.createDataFrame([("a", i)], table.schema))
        sizes.append((table.log().count(), len(table.read()._jdf.inputFiles())))
    assert content(table) == [("a", 25), ("b", 0)]
    assert max(sizes[-8:]) <= max(sizes[:8])
    assert len(os.listdir(f"{folder}/t/log")) < 20
    assert len(table.vacuum()) == 24 and content(table) == [("a", 25), ("b", 0)]
    table.delete_where(F.col("k") == 0)
    assert content(table) == [("a", 25)]


def test_audit_rows_can_be_deleted(spark, folder):
    log = AuditLog(spark, folder + "/audit")
    for name in ["one", "two", "three"]:
        log.add("PIPELINE_RUNS", BATCH_ID=name, STATUS="SUCCESS")
    log.delete_where("PIPELINE_RUNS", F.col("BATCH_ID") == "two")
    assert {r.BATCH_ID for r in log.table("PIPELINE_RUNS").collect()} == {"one", "three"}
    assert len(log.table("PIPELINE_RUNS").inputFiles()) == 1
    log.add("PIPELINE_RUNS", BATCH_ID="four", STATUS="FAILED")
    assert log.table("PIPELINE_RUNS").count() == 3


class Killed(BaseException):
    pass


@pytest.mark.parametrize("steps", range(7))
def test_a_rewrite_killed_between_any_two_steps_keeps_every_row(spark, folder, monkeypatch, steps):
    """Kill after each write and deletion in turn; then append, rewrite and read as if nothing had happened."""
    log = RowLog(spark, f"{folder}/log", "k bigint")
    values = lambda: sorted(r.k for r in log.read().collect())
    for k in range(3):
        log.append(spark.range(k, k + 1).toDF("k"))
    log.compact()
    log.append(spark.range(3, 4).toDF("k"))
    done = []

    def dying(work):
        def step(*args):
            if len(done) == steps:
                raise Killed
            done.append(1)
            return work(*args)

        return step

    with monkeypatch.context() as patch:
        patch.setattr("sluiceway.sources.rowlog.delete_path", dying(rowlog.delete_path))
        patch.setattr(RowLog, "_show", dying(RowLog._show))
        patch.setattr(RowLog, "_clean", dying(RowLog._clean))
        try:
            log.compact()
        except Killed:
            pass
    assert values() == [0, 1, 2, 3]
    # A head that died half way is a folder without a row.
    os.makedirs(f"{folder}/log/heads/{99:012d}")
    log.append(spark.range(4, 5).toDF("k"))
    assert values() == [0, 1, 2, 3, 4]
    log.rewrite(lambda rows: rows.where("k <> 2"))
    log.compact()
    assert values() == [0, 1, 3, 4] and len(log.read().inputFiles()) == 1


def test_many_appends_are_gathered(spark, folder, monkeypatch):
    monkeypatch.setattr(rowlog, "COMPACT_EVERY", 5)
    log = RowLog(spark, f"{folder}/log", "k bigint")
    for k in range(17):
        log.append(spark.range(k, k + 1).toDF("k"))
        assert len(log.read().inputFiles()) <= 5
    assert sorted(r.k for r in log.read().collect()) == list(range(17))
    assert len(os.listdir(f"{folder}/log/rows")) < 12 and len(os.listdir(f"{folder}/log/base")) <= 2


def test_verdicts_on_the_driver_are_the_same(spark):
    suite = [Check("a", "x"), Check("b", "x", None, 1, None), Check("c", "x", None, None, 3), Check("d", "x")]
    values = {"a": 0, "b": 0.5, "c": 3, "d": None}
    frame = spark.createDataFrame([(0.0, 0.5, 3.0, None)], "a double, b double, c double, d double")
    fields = ["metric", "category", "source", "value", "low", "high", "passed", "detail"]
    one = {tuple(r[f] for f in fields) for r in judge(values, suite)}
    assert one == {tuple(r[f] for f in fields) for r in verdicts(frame, suite).collect()}


def test_key_runs_stay_few_and_survive_a_kill(spark, folder, monkeypatch):
    """Twenty epochs: bounded folders, every key kept, also when a gathering dies before or after its entry is written."""
    monkeypatch.setattr(stream_gates, "LOOSE_EPOCHS", 4)
    runs, want = KeyRuns(f"{folder}/keys"), set()
    runs.seed(spark.range(5).select(F.concat(F.lit("s"), "id").alias("k")))
    runs.seed(spark.range(9).select(F.concat(F.lit("never"), "id").alias("k")))

    def keys(epoch):
        found = runs.folders(spark, epoch)
        return {r.k for r in spark.read.parquet(*found).select("k").collect()} if found else set()

    want |= {f"s{i}" for i in range(5)}
    for epoch in range(20):
        runs.add(spark.createDataFrame([(f"k{epoch}-{i}",) for i in range(3)] + [("same",)], "k string"), epoch)
        assert keys(epoch) == want
        if epoch in (7, 13):
            with monkeypatch.context() as patch:
                patch.setattr(stream_gates, "delete_path", lambda *a: (_ for _ in ()).throw(Killed()))
                try:
                    runs.gather(spark, "k", epoch)
                except Killed:
                    pass
            os.makedirs(f"{folder}/keys/heads/{10**9:012d}", exist_ok=True)
        else:
            runs.gather(spark, "k", epoch)
        assert len(os.listdir(f"{folder}/keys/epochs")) <= 12
        want |= {f"k{epoch}-{i}" for i in range(3)} | {"same"}
    assert keys(20) == want and len(os.listdir(f"{folder}/keys/runs")) <= 3


def test_files_limited_in_bytes(spark, folder):
    rows = spark.range(0, 60_000, 1, 3).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    unload_parquet(rows, f"{folder}/u", max_bytes_per_file=400_000)
    sizes = [r.length for r in list_files(spark, f"{folder}/u", "*.parquet").collect()]
    assert max(sizes) <= 400_000 and min(sizes) >= 0.8 * 400_000 and len(sizes) > 5
    assert spark.read.parquet(f"{folder}/u").agg(F.count("*"), F.sum("id")).first() == (60_000, 60_000 * 59_999 // 2)
    unload_parquet(rows.limit(0), f"{folder}/none", max_bytes_per_file=1000)
    assert spark.read.parquet(f"{folder}/none").count() == 0
    with pytest.raises(ValueError, match="rows are too large"):
        unload_parquet(rows.limit(3), f"{folder}/one", max_bytes_per_file=10)
