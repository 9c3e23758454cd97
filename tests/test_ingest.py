"""Snapshot ingest (S1-S4), files (S5, S6, S8, S9) and the incremental stream."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from membra.sources import files as fl
from membra.sources import snapshots as snap
from membra.streaming.snapshot_stream import facts_stream, merge_facts, snapshot_stream

GOOD = """HSAG:
- {name: Ann Smith, bioguide: S000001, title: Chair, icpsr: 101}
- name: Bob Jones
  bioguide: J000002
  icpsr: 102
SSFI: []
JSEC:
- {name: Cy Young, bioguide: Y000003, party: minority}
"""


def test_decode_document_cases():
    ok, _, r = snap.decode_document(GOOD, "committee-membership-2020-12-07-abcdef1.yaml")
    assert ok and [(g, m["name"]) for g, _, _, m in r] == [
        ("HSAG", "Ann Smith"), ("HSAG", "Bob Jones"), ("JSEC", "Cy Young")]
    assert r[0][3]["icpsr"] == "101" and "title" not in r[1][3]
    cases = {
        "A:\n- {name: x}\nA:\n- {name: y}\n": "duplicate key",
        "A: [\n": "unparsable",
        "": "empty or not a mapping",
        "# nothing\n": "empty or not a mapping",
        "- a\n- b\n": "empty or not a mapping",
        "A:\n- {name: x, name: y}\n": "duplicate key",
    }
    for text, kind in cases.items():
        ok, reason, r = snap.decode_document(text, "committee-membership-2020-12-07-abcdef1.yaml")
        assert not ok and reason.startswith(kind) and r == [], (text, reason)
    ok, _, r = snap.decode_document("A:\n- just text\n- {name: x}\n-\n",
                                    "committee-membership-2020-12-07-abcdef1.yaml")
    assert ok and [m for _, _, _, m in r] == [{"value": "just text"}, {"name": "x"}]
    ok, reason, _ = snap.decode_document(GOOD, "committee-membership-latest.yaml")
    assert not ok and reason.startswith("no date")


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_plain_folder_listing_and_members(spark):
    d = tempfile.mkdtemp(prefix="membra-snap-")
    _write(d, "committee-membership-2019-01-02-abcdef1.yaml", GOOD)
    _write(d, "committee-membership-2019-01-03-abcdef2.yaml", "HSAG:\n- {name: Z, icpsr: 9}\n")
    _write(d, "committee-membership-2019-02-01-abcdef3.yaml", "HSAG: [\n")
    _write(d, "committee-membership-2019-02-01.yaml", GOOD)  # no sha: not listed
    _write(d, "notes.txt", "x")
    files = snap.list_snapshots(spark, d)
    assert sorted(r[0] for r in files.select("source_file").collect()) == [
        "committee-membership-2019-01-02-abcdef1.yaml",
        "committee-membership-2019-01-03-abcdef2.yaml",
        "committee-membership-2019-02-01-abcdef3.yaml"]
    decoded = snap.decode_snapshots(files)
    assert rows(snap.quarantine(decoded), "source_file") == [
        ("committee-membership-2019-02-01-abcdef3.yaml",)]
    m = snap.member_rows(decoded)
    assert set(m.columns) >= {"snapshot_date", "congress", "name", "party", "thomas_id"}
    got = rows(m, "congress", "thomas_id", "name", "party")
    assert got == sorted([(115, "HSAG", "Ann Smith", None), (115, "HSAG", "Bob Jones", None),
                          (115, "JSEC", "Cy Young", "minority"), (116, "HSAG", "Z", None)],
                         key=repr)


def test_one_bad_part_takes_the_whole_version(spark):
    d = tempfile.mkdtemp(prefix="membra-parts-")
    docs = {("committee-membership-2021-01-05-aaaaaaa.yaml", 0): GOOD,
            ("committee-membership-2021-01-05-aaaaaaa.yaml", 1): "HSAG: [\n",
            ("committee-membership-2021-02-05-bbbbbbb.yaml", 0):
                "HSAG:\n- {name: Z, start_date: 2021-01-03, congress: x}\n",
            ("committee-membership-2021-02-05-bbbbbbb.yaml", 1): "SSFI:\n- bare\n"}
    for (name, k), text in docs.items():
        p = os.path.join(d, f"file_name={name}", f"salt={k}")
        os.makedirs(p)
        _write(p, "part-0.txt", text)
    decoded = snap.decode_snapshots(snap.list_snapshots(spark, d, partitioned=True))
    assert rows(snap.quarantine(decoded), "source_file") == [
        ("committee-membership-2021-01-05-aaaaaaa.yaml",)]
    m = snap.member_rows(decoded, always=("name", "title"))
    assert rows(m, "thomas_id", "name", "title", "start_date", "congress_member", "value") == sorted(
        [("HSAG", "Z", None, "2021-01-03", "x", None), ("SSFI", None, None, None, None, "bare")],
        key=repr)


def test_stream_is_incremental(spark):
    landing = tempfile.mkdtemp(prefix="membra-land-")
    sink, ckpt = landing + "-sink", landing + "-ckpt"
    first = os.path.join(landing, "file_name=committee-membership-2021-01-05-aaaaaaa.yaml")
    os.makedirs(first)
    _write(first, "part-0.txt", GOOD)
    out = snapshot_stream(spark, landing, sink, ckpt)
    assert out.filter("ok").count() == 3
    second = os.path.join(landing, "file_name=committee-membership-2021-02-05-bbbbbbb.yaml")
    os.makedirs(second)
    _write(second, "part-0.txt", "SSFI:\n- {name: New One, icpsr: 5}\n")
    out = snapshot_stream(spark, landing, sink, ckpt)
    # the first file is not read again; only the new member is added
    assert out.filter("ok").count() == 4
    assert out.filter(F.col("member")["name"] == "New One").count() == 1


def _facts(decoded):
    return snap.per_period_distinct(snap.member_rows(decoded, ["name", "icpsr"]),
                                    ["congress", "thomas_id", "name", "icpsr"])


def _land(landing, name, text):
    p = os.path.join(landing, f"file_name={name}")
    os.makedirs(p)
    _write(p, "part-0.txt", text)


FACT_DOCS = {"committee-membership-2021-01-05-aaaaaaa.yaml": "HSAG:\n- {name: A, icpsr: 1}\n- {name: B}\n- {name: B}\n",
             "committee-membership-2021-02-05-bbbbbbb.yaml": "HSAG:\n- {name: B}\n- {name: C, icpsr: 3}\n",
             "committee-membership-2021-02-06-ddddddd.yaml": "HSAG: [\n",
             "committee-membership-2023-02-05-ccccccc.yaml": "HSAG:\n- {name: B}\n"}


def test_facts_of_several_landings_are_those_of_one(spark):
    once = tempfile.mkdtemp(prefix="membra-facts-")
    step = tempfile.mkdtemp(prefix="membra-facts-")

    def run(landing):
        return facts_stream(spark, landing, landing + "-sink", landing + "-ckpt", _facts)

    assert run(step).count() == 0  # nothing landed
    for name, text in FACT_DOCS.items():
        _land(once, name, text)
        _land(step, name, text)
        run(step)
    cols = ("congress", "thomas_id", "name", "icpsr")
    want = rows(run(once), *cols)
    assert rows(run(step), *cols) == want
    assert want == sorted([(117, "HSAG", "A", "1"), (117, "HSAG", "B", None), (117, "HSAG", "C", "3"),
                           (118, "HSAG", "B", None)], key=repr)
    # each file is decoded by one batch, and a fact is written by the first that has it
    decoded = spark.read.option("basePath", step + "-sink/decoded").parquet(step + "-sink/decoded")
    assert decoded.groupBy("source_file").agg(F.countDistinct("batch").alias("n")).filter("n > 1").isEmpty()
    assert decoded.select("batch").distinct().count() == len(FACT_DOCS)


def test_a_repeated_batch_adds_nothing(spark):
    landing = tempfile.mkdtemp(prefix="membra-facts-")
    sink = landing + "-sink"
    for name, text in list(FACT_DOCS.items())[:1]:
        _land(landing, name, text)
    facts = facts_stream(spark, landing, sink, landing + "-ckpt", _facts)
    before = rows(facts, *facts.columns)
    files = snap.decode_snapshots(snap.list_snapshots(spark, landing, partitioned=True))
    for batch in (0, 0, 1, 1):
        merge_facts(files, batch, sink, _facts)
    again = spark.read.schema(facts.schema).parquet(sink + "/facts")
    assert len(before) == 2 and rows(again, *facts.columns) == before


def test_typed_csv_positional_stage_and_report(spark):
    d = tempfile.mkdtemp(prefix="membra-csv-")
    p = os.path.join(d, "corr.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('congress,chamber,bioname,,icpsr,member_groups\n'
                '116,House,"SMITH, Ann",,101,"A | B|C"\n'
                '116,House,"JONES, Bob",,NA,0\n')
    schema = ("congress int, chamber string, bioname string, `...4` string, icpsr int, "
              "member_groups string")
    df = fl.read_csv_typed(spark, p, schema)
    assert "...4" in df.columns
    assert rows(df.withColumnRenamed("...4", "blank"), "bioname", "blank", "icpsr",
                "member_groups") == [
        ("JONES, Bob", None, None, "0"), ("SMITH, Ann", None, 101, "A | B|C")]
    renamed = fl.rename_positional(df, ["a", "b", "c", "d", "e", "f"])
    assert renamed.columns == ["a", "b", "c", "d", "e", "f"]
    staged = fl.save_stage(df, os.path.join(d, "stage"))
    assert staged.count() == 2
    fl.write_report(staged, os.path.join(d, "report"))
    outs = [f for f in os.listdir(os.path.join(d, "report")) if f.endswith(".csv")]
    assert len(outs) == 1


def test_decoder_holds_one_document_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    name = "committee-membership-2021-01-05-aaaaaaa.yaml"
    text = "HSAG:\n" + "".join(f"- {{name: N{i}}}\n" for i in range(12))
    texts = [text] * 4 + ["HSAG: [\n", "", None, "SSFI: []\n", text]
    files = pa.RecordBatch.from_arrays([pa.array(v, type=pa.string()) for v in (
        [name] * len(texts), [f"p{i}" for i in range(len(texts))], texts)], names=["source_file", "source_path", "content"])
    begun, decode = [], snap.decode_document
    monkeypatch.setattr(snap, "decode_document", lambda t, n: (begun.append(n), decode(t, n))[1])
    monkeypatch.setattr(snap, "ROWS_PER_BATCH", 5)
    out, most = [], []
    for b in snap._decode_batches(iter([files])):
        out += b.to_pylist()
        most.append((b.num_rows, len(begun)))
    assert max(n for n, _ in most) == 5 and [k for _, k in most] == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3 + [5, 6, 7] + [9] * 3
    assert [r["reason"].split(":")[0] for r in out if not r["ok"]] == ["unparsable", "empty or not a mapping", "empty or not a mapping"]
    good = [r for r in out if r["ok"]]
    assert [r["member"] for r in good] == [[("name", f"N{i}")] for i in range(12)] * 5
    # files reach the decoder in bounded batches, in the stream as well
    snap.decode_snapshots(spark.createDataFrame([], "source_file string, source_path string, content string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= snap.BATCH_BYTES
