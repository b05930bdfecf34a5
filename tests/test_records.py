"""Records with quoted line breaks: the line-by-line reader against the csv module, row by row."""

import csv
import os
import random

import pytest

from occurra.operators.normalize import normalize_download
from occurra.sources import readers as R
from occurra.sources import records as S

HEADER = ["gbifID", "species", "eventDate", "note"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def plain(path):
    with open(path, encoding="utf-8", newline="") as f:
        return [tuple(r.get(c) or None for c in HEADER) for r in csv.DictReader(f, delimiter="\t")]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "70", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


PIECES = ["a", "é", " ", "two words", '"', '""', "\t", "\n", "\r\n", "\n\n", "x,y", "\\"]


def field(rng):
    text = "".join(rng.choices(PIECES, k=rng.randint(0, 6)))
    if rng.random() < 0.5 and not set("\t\n\r") & set(text) and not text.startswith('"'):
        return text  # unquoted, also with quotes inside
    return '"' + text.replace('"', '""') + '"'


def export(rng, records, end):
    rows = ["\t".join(HEADER)] + ["\t".join([str(k), field(rng), field(rng), field(rng)]) for k in range(records)]
    return end.join(rows) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("seed", range(3))
def test_records_equal_a_plain_read(spark, scratch, small_splits, seed):
    rng = random.Random(seed)
    root = os.path.join(scratch, f"records {seed}")
    for part, end in enumerate(("\n", "\r\n", "\n")):
        write(f"{root}/part-{part}.txt", export(rng, 40, end))
    write(f"{root}/long.txt", "\t".join(HEADER) + '\n1\t"' + "many\nlines\n" * 60 + '"\t\t"x\n"\n2\tplain\t\t\n')
    df = R.read_download_export(spark, root)
    assert S.physical_lines(spark, root).rdd.getNumPartitions() > 20
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r._file, r._block, r._row)):
        got.setdefault(os.path.basename(r._file), []).append(tuple(r[c] for c in HEADER))
    assert got == {name: plain(f"{root}/{name}") for name in os.listdir(root)}
    # the read of whole files gives the same records
    whole = R.read_download_export(spark, root, multi_line=True)
    rows = lambda d: sorted(map(str, d.select(*HEADER).collect()))
    assert len(rows(whole)) == len(rows(df))


def test_two_records_stay_two(spark, scratch):
    root = os.path.join(scratch, "two records")
    write(f"{root}/a.csv", '\t'.join(HEADER) + '\n1\tcorvus\t2024-01-02\t"two\nlines"\n2\tpica\t2024-01-03\t\n')
    rows = normalize_download(R.arrival_order(R.read_download_export(spark, root)), carry=("_file", "_block", "_row")).collect()
    assert sorted((r.gbif_id, r.species, str(r.event_date)) for r in rows) == [("1", "corvus", "2024-01-02"), ("2", "pica", "2024-01-03")]
    assert sorted((r._row for r in rows)) == [1, 3]


def test_without_line_breaks_every_line_is_a_record(spark, scratch):
    root = os.path.join(scratch, "no breaks")
    write(f"{root}/a.csv", '\t'.join(HEADER) + '\n1\t"quoted ""word"""\t5" long\t"tab\there"\n\n2\ta\tb\tc\n')
    df = R.read_download_export(spark, root)
    assert "_row" not in df.columns  # read directly, no line is put together
    assert [tuple(r[c] for c in HEADER) for r in df.collect()] == plain(f"{root}/a.csv")


def test_other_headers_and_unclosed_quotes_fail(spark, scratch, small_splits):
    root = os.path.join(scratch, "other header")
    write(f"{root}/a.txt", '\t'.join(HEADER) + '\n1\ta\tb\t"c\nd"\n')
    write(f"{root}/b.txt", '\t'.join(reversed(HEADER)) + '\n1\ta\tb\tc\n')
    with pytest.raises(Exception, match="header"):
        R.read_download_export(spark, root).collect()
    root = os.path.join(scratch, "unclosed")
    write(f"{root}/a.txt", '\t'.join(HEADER) + '\n1\ta\tb\t"c\n' + "2\ta\tb\tc\n" * 300)
    with pytest.raises(ValueError, match="not closed"):
        S.read_records(S.physical_lines(spark, root), HEADER, max_lines=100)
    rows = R.read_download_export(spark, root).collect()
    assert len(rows) == 1 and rows[0].note.startswith("c\n2\ta") and len(rows[0].note) > 2000


def test_text_of_whole_records_is_not_shuffled(spark, scratch):
    root = os.path.join(scratch, "two records")
    plan = R.read_download_export(spark, root)._jdf.queryExecution().executedPlan().toString()
    # the lines themselves meet the few broken ones in a broadcast; only parts of records are grouped
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
