import random
import re

import pytest

from helpers import tuples
from tallyhouse.sources.lines import read_multiline

FIELD = r'(?:"[^"]*(?:""[^"]*)*"|(?!")[^,\n]*)'
RECORD = re.compile(rf"(?:{FIELD}(?:,{FIELD})*(?=\n|\Z))|[^\n]+")


def records(text):
    """One after the other: the longest run of whole fields that ends with a line, or else the line as it is."""
    out, at, text = [], 0, text.replace("\r\n", "\n")
    while at < len(text):
        match = RECORD.match(text, at)
        if match:
            out.append(match[0])
            at = match.end()
        at += 1
    return [record for record in out if record]


@pytest.fixture
def split_bytes(spark):
    """Sets how many bytes of a file a task reads."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    yield lambda size: [spark.conf.set(name, str(size)) for name in names]
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [7, 40, 10_000])
def test_records_over_splits_equal_the_file_as_a_whole(spark, tmp_path, split_bytes, size):
    """Random files of quotes, commas and breaks, cut into tiny splits."""
    rng = random.Random(size)
    want = []
    for k in range(25):
        pieces = ["a", ",", '"', '""', "\n", "\r\n", '"x"', ',"', '",', "bc", '\n"', '"\n']
        text = "".join(rng.choices(pieces, (4, 4, 1, 1, 4, 1, 1, 2, 2, 3, 1, 1), k=rng.randint(0, 70)))
        text += rng.choice(["", "\n"])
        (tmp_path / f"f{k:02d}.csv").write_bytes(text.encode())
        want += [(f"f{k:02d}.csv", record) for record in records(text.removesuffix("\r"))]
    split_bytes(size)
    found = read_multiline(spark, str(tmp_path))
    got = [(path.rpartition("/")[2], value) for path, value in tuples(found, "file_path", "value")]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []),
        ("\n\n", []),
        ('a,"b\n\nc",d\ne', ['a,"b\n\nc",d', "e"]),
        ('a,"open\nb,c\n"q",d\n', ['a,"open', "b,c", '"q",d']),
        ('"a\nb"x\nc', ['"a', 'b"x', "c"]),
        ('"a\r\nb",c\r\n', ['"a\nb",c']),
        ('"a\nb","c\nd"\n', ['"a\nb","c\nd"']),
        ('"a\nb","c\nd"x\n"e\nf"', ['"a', 'b","c', 'd"x', '"e\nf"']),
    ],
)
def test_what_a_record_is(spark, tmp_path, split_bytes, text, want):
    (tmp_path / "one.csv").write_bytes(text.encode())
    split_bytes(5)
    assert sorted(tuples(read_multiline(spark, str(tmp_path)), "value")) == sorted((v,) for v in want)
    assert records(text) == want
