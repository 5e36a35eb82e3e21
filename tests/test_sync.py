import os

from skeinwork.sources import sync


def tree(root, files):
    for path, text in files.items():
        place = root / path
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(text)


def names(rows):
    return sorted(r.path for r in rows.select("path").collect())


def test_listing_by_prefix_and_filter(spark, tmp_path):
    tree(tmp_path, {"a.txt": "1", "x/b.c": "22", "x/deep/c.c": "333", "y/d.h": "4444", "z/e.c": ""})
    rows = sync.listing(spark, f"file://{tmp_path}")
    assert names(rows) == ["a.txt", "x/b.c", "x/deep/c.c", "y/d.h", "z/e.c"]
    assert {r.path: r.length for r in rows.collect()}["x/deep/c.c"] == 3
    assert names(rows.filter("length <= 0 or path = 'a.txt'")) == ["a.txt", "z/e.c"]
    assert names(rows.filter("path = 'y/d.h' and modified > timestamp'2001-01-01'")) == ["y/d.h"]
    for prefix, want in (("x/", ["x/b.c", "x/deep/c.c"]), ("x/deep/", ["x/deep/c.c"]), ("a", ["a.txt"]), ("none", [])):
        assert names(sync.listing(spark, f"file://{tmp_path}", prefix)) == want
    # Folders that the prefix rules out are not listed.
    assert [p.value for p in sync.ListingReader(f"file://{tmp_path}", "x/de").partitions()] == ["", "x/"]
    assert rows.rdd.getNumPartitions() == 4
    assert names(sync.listing(spark, f"file://{tmp_path}/none")) == []


def test_only_what_changed_is_copied(spark, tmp_path):
    source, target = tmp_path / "s", tmp_path / "t"
    tree(source, {"a.txt": "one", "x/b.c": "two", "x/y/c.c": "three", "empty.c": ""})
    uris = f"file://{source}", f"file://{target}"
    first = sync.sync(spark, *uris, str(tmp_path / "r1"), 2)
    assert names(first) == ["a.txt", "empty.c", "x/b.c", "x/y/c.c"] and first.filter("error is not null").count() == 0
    assert (target / "x/y/c.c").read_text() == "three"
    assert not [p for p in target.rglob("*") if p.name.endswith(".partial")]
    assert sync.sync(spark, *uris, str(tmp_path / "r2"), 2).count() == 0
    (source / "a.txt").write_text("longer")
    (source / "x/b.c").write_text("TWO")  # of the same size
    os.utime(source / "x/b.c", (4e9, 4e9))
    (target / "x/y/c.c").unlink()
    (target / "own.txt").write_text("only here")
    assert names(sync.removed(sync.listing(spark, uris[0]), sync.listing(spark, uris[1]))) == ["own.txt"]
    third = sync.sync(spark, *uris, str(tmp_path / "r3"), 2)
    assert names(third) == ["a.txt", "x/b.c", "x/y/c.c"]
    assert [(target / p).read_text() for p in ("a.txt", "x/b.c", "x/y/c.c", "own.txt")] == ["longer", "TWO", "three", "only here"]


def test_a_file_that_cannot_be_copied(spark, tmp_path):
    files = spark.createDataFrame([("gone.txt", 3)], "path string, length long")
    (tmp_path / "s").mkdir()
    row = sync.copy_files(files, f"file://{tmp_path}/s", f"file://{tmp_path}/t", 1).first()
    assert row.path == "gone.txt" and row.error
