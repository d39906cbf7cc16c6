"""Lines that need no parser are cut at once; all others go through it, with the same result."""

import csv
import hashlib

import pyarrow as pa

from claimwright.sources import files, records


def batches(*parts, file="f.csv", split=0):
    schema = ["line", "source_file", "split"]
    return [
        pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array([file] * len(lines)), pa.array([split] * len(lines), pa.int64())], names=schema)
        for lines in parts
    ]


def cells(parts, width=2, limit=records.NO_LIMIT):
    out = [r for b in records._parsed(parts, width, set(), limit=limit) for r in b.to_pylist()]
    return sorted(tuple(r[f"c{k}"] for k in range(width)) for r in out)


def profiled(parts, size):
    return [files._profile(lines, size) for _, lines in records.slices_by_split(parts)]


def test_plain_lines_need_no_parser(monkeypatch):
    def parser(*_):
        raise AssertionError("parsed line by line")

    monkeypatch.setattr(csv, "reader", parser)
    parts = batches([b"a,b", b"1,x ", b"", "2,é".encode()], [b"3,"])
    assert cells(parts) == [("1", "x "), ("2", "é"), ("3", "")]
    content = "a,b\n1,x \n\n2,é\n3,".encode()
    assert profiled(parts, len(content)) == [(hashlib.sha256(content).hexdigest(), ["a", "b"], False, None)]


def test_other_lines_go_through_the_parser():
    mixed = [[b"a,b", b'1,"x', b'y"'], [b"2", b"3,c,d"], [b"4,p", b"5,q\r6,r"], [b'7,"s'], [b't"', b"8,u"], [b"\xef\xbb\xbf9,v"]]
    assert cells(batches(*mixed)) == [("1", "x\ny"), ("2", ""), ("3", "c"), ("4", "p"), ("5", "q"), ("6", "r"), ("7", "s\nt"), ("8", "u"), ("﻿9", "v")]
    content = b"\n".join(line for part in mixed for line in part) + b"\n"
    assert profiled(batches(*mixed), len(content)) == [(hashlib.sha256(content).hexdigest(), ["a", "b"], True, None)]


def test_faults_of_plain_looking_lines_are_found():
    for fault, name in ((b"x,\xff", "UnicodeDecodeError"), (b"x" * (records.FIELD_LIMIT + 1) + b",y", "Error")):
        lines = [b"a,b", b"1,2", fault, b"3,4"]
        content = b"\n".join(lines) + b"\n"
        with records.field_limit(records.FIELD_LIMIT):
            (file_hash, header, _, error), = profiled(batches(lines[:2], lines[2:]), len(content))
        assert (file_hash, header) == (hashlib.sha256(content).hexdigest(), ["a", "b"]) and error.startswith(f"{name}: ")
