"""CSV by blocks against the parser of whole files, at many block sizes."""

import csv
import io

import numpy as np
import pytest

from pagequarry.sources import csv_blocks as B
from pagequarry.sources import folder, tabular


def text(rows, end="\n", **how):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, **how).writerows(rows)
    return out.getvalue().encode()


def files():
    rng = np.random.default_rng(3)
    words = ["plain", "with, comma", 'a "quoted" word', "two\nlines", "\r\nodd\r ends\n\n", "", "é😀", '"', "12", " "]
    rows = [[words[i] for i in rng.integers(0, len(words), 4)] for _ in range(120)]
    head = ["id", "name", "name", ""]
    return {
        "lf.csv": text([head, *rows]), "crlf.csv": text([head, *rows], "\r\n"), "cr.csv": text([head, *rows], "\r"), "all.csv": text([head, *rows], quoting=csv.QUOTE_ALL),
        "bom.csv": b"\xef\xbb\xbf" + text([["a", "b"], ["1", "2"]]), "bomq.csv": b'\xef\xbb\xbf"a","b"\n1,2\n', "noend.csv": b'a,b\n1,"2\n3"', "open.csv": b'a,b\n1,"2\n3\n4,5\n', "blank.csv": b"\n\na,b\n\n\n1,2\n\n",
        "labels.csv": b"a,b\nx,1,2\ny,3\n", "wide.csv": b"a,b\n1,2\n3,4,5\n", "empty.csv": b"", "only.csv": b"a,b", "bad.csv": b"a,b\n\xff,2\n",
        "long.csv": b"a,b\n1," + b'"' + b"x\n" * 5000 + b'"' + b"\n2,3\n", "odd.csv": b'a,b\n5" disc,6\n7,8\n', "odd2.csv": b'a,b\n"x"y"z,1\n2,3\n', "one.csv": b"a\n1\n2\n",
    }


@pytest.mark.parametrize("block", [1 << 20, 1000, 37, 16])
def test_cells_equal_those_of_whole_files(spark, tmp_path, block):
    made = files()
    if block < 30:
        made = {n: b for n, b in made.items() if len(b) < 100}
    for name, body in made.items():
        (tmp_path / name).write_bytes(body)
    listed = folder.scan_folder(spark, str(tmp_path)).select("path", "length")
    whole = tabular.csv_cells(folder.scan_folder(spark, str(tmp_path), content=True))
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    got, want = key(B.csv_cells_by_blocks(listed, str(tmp_path), block)), key(whole)
    assert got == want and len(want) > 10
    if block < 100:
        turned = B.csv_blocks(listed, block)
        assert turned.count() >= sum(-(-len(b) // block) for b in made.values())


def test_rows_that_begin_in_a_block(tmp_path):
    """Every block size cuts every file into the same bytes."""
    for name, body in files().items():
        if not name.startswith(("odd", "long", "empty")):
            (tmp_path / name).write_bytes(body)
            fs, base, _ = folder.file_system(str(tmp_path / name))
            for block in (1, 2, 3, 7, 50):
                parts, inside = [], 0
                with fs.open_input_file(base) as f:
                    for start in range(0, len(body), block):
                        parts.append(B.rows_of_block(f, len(body), start, block, inside)[0])
                        inside = (inside + body[start:start + block].count(b'"')) % 2
                assert b"".join(parts) == body, (name, block)


def test_one_file_in_many_tasks(spark, tmp_path):
    rows = [[str(i), f"line {i}\nand more", i * 0.5 if i % 3 else ""] for i in range(3000)]
    (tmp_path / "big.csv").write_bytes(text([["id", "note", "x"], *rows]))
    listed = folder.scan_folder(spark, str(tmp_path)).select("path", "length")
    table = B.read_csv_blocks(spark, listed, str(tmp_path), "id long, note string, x double", block_bytes=5000)
    assert sorted(map(tuple, table.collect())) == [(i, f"line {i}\nand more", i * 0.5 if i % 3 else None) for i in range(3000)]
    (tmp_path / "odd.csv").write_bytes(b'id,note,x\n1,5" disc,2\n')
    with pytest.raises(ValueError, match="odd.csv"):
        B.read_csv_blocks(spark, folder.scan_folder(spark, str(tmp_path)).select("path", "length"), str(tmp_path), "id long, note string, x double")
