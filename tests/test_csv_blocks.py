import io
import random

import pytest
from pyspark.sql import types as T

from parlato.sources import csv_blocks
from parlato.sources.csv_blocks import csv_records, quoted_at_end, record_ends
from parlato.sources.tables import read_csv

CELLS = ["", "a", "é", 'x"y', "\n", "a\r\nb", '"', '""', ",", 'q",\n"', " s ", "5\" disk", "\n\n\n"]


def plain_records(text):
    """Records by one pass over characters."""
    records, now, quoted, begins = [], "", False, True
    k = 0
    while k < len(text):
        c = text[k]
        if quoted:
            if c == '"' and text[k + 1 : k + 2] == '"':
                now += '""'
                k += 2
                continue
            quoted = c != '"'
            now += c
        elif c == '"' and begins:
            quoted = True
            now += c
        elif c == "\n":
            records.append(now.rstrip("\r"))
            now = ""
        else:
            now += c
        begins = not quoted and c in ",\n\r"
        k += 1
    return [r for r in [*records, now] if r]


def written(rng, rows, stray=True, head="", end=None):
    def cell(value):
        if any(c in value for c in '",\n\r'):
            if stray and value == '5" disk':
                return value
            return '"' + value.replace('"', '""') + '"'
        return value

    end = end or rng.choice(["\n", "\r\n"])
    text = head and head + end
    text += "".join(",".join(cell(rng.choice(CELLS)) for _ in range(3)) + end for _ in range(rows))
    return text if rng.random() < 0.7 else text.rstrip("\r\n")


def test_state_and_cuts_follow_the_characters():
    rng = random.Random(5)
    for _ in range(400):
        text = written(rng, rng.randrange(6))
        data = text.encode()
        cuts = [0, *record_ends(data), len(data)]
        assert [r for a, b in zip(cuts, cuts[1:]) if (r := data[a:b].decode().rstrip("\r\n"))] == plain_records(text)
        for at in [k + 1 for k, b in enumerate(data) if b == 10]:
            state = quoted_at_end(data[:at], False)
            assert quoted_at_end(data[at:], state) == quoted_at_end(data, False)


@pytest.mark.parametrize("block", [7, 40, 300, 10**6])
def test_records_for_any_block_size(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(csv_blocks, "_READ_BYTES", 16)
    rng = random.Random(block)
    texts = {f"{k}.csv": written(rng, rng.choice([0, 1, 8, 30])) for k in range(12)}
    texts["long.csv"] = 'a,"' + "x\n" * 300 + '",b\n"",c,d\n'
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    files = spark.createDataFrame([(f"{tmp_path}/{n}", (tmp_path / n).stat().st_size) for n in texts], "path string, size long")
    rows = csv_records(spark, files, str(tmp_path), block).orderBy("file", "block", "place").collect()
    for name, text in texts.items():
        assert [r["record"] for r in rows if r["file"] == f"{tmp_path}/{name}"] == plain_records(text)


def test_same_rows_as_one_task(spark, tmp_path):
    rng = random.Random(9)
    for name in ("a b.csv", "c.csv"):
        # one kind of line end: the reader of whole files takes the first that it sees for all
        (tmp_path / name).write_bytes(written(rng, 400, stray=False, head="id,n,text", end="\n").encode())
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("id", T.StringType())])
    whole = read_csv(spark, str(tmp_path), schema, order="at")
    split = read_csv(spark, str(tmp_path), schema, order="at", split_bytes=500)
    assert split.rdd.getNumPartitions() > 2
    want, got = ([tuple(r)[:2] for r in df.orderBy("at").collect()] for df in (whole, split))
    assert [tuple(c and c.replace("\r\n", "\n") for c in r) for r in got] == [tuple(c and c.replace("\r\n", "\n") for c in r) for r in want]
    one = read_csv(spark, f"{tmp_path}/a b.csv", split_bytes=500)
    assert one.columns == ["id", "n", "text"] and one.count() == read_csv(spark, f"{tmp_path}/a b.csv").count()


def test_a_large_file_in_several_tasks(spark, tmp_path):
    line = b'1,"' + b"word \n" * 2000 + b'"\n'
    n = (66 << 20) // len(line)
    with open(tmp_path / "large.csv", "wb") as out:
        out.write(b"id,text\n")
        for _ in range(n):
            out.write(line)
    df = read_csv(spark, f"{tmp_path}/large.csv")
    assert df.rdd.getNumPartitions() > 1
    assert df.where("length(text) = 12000 and id = '1'").count() == n


def test_reading_stream_ends(tmp_path):
    assert csv_blocks._line_start(io.BytesIO(b"abc"), 2, 3) == 3
    assert csv_blocks._line_start(io.BytesIO(b"a\nc"), 2, 3) == 2
