import io
import tarfile
import zipfile

from tessera.sources.archives import archive_members


def test_members_of_zip_and_tar(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/barcodes.tsv.gz", b"one")
        z.writestr("x/readme.txt", b"no")
        z.writestr("x/", b"")
    for name, mode in (("b.tar.gz", "w:gz"), ("c.zip", "w")):  # told by its bytes: the last is a tar
        with tarfile.open(tmp_path / name, mode) as t:
            for m, data in (("y/matrix.mtx", b"two" * 1000), ("y/other", b"")):
                info = tarfile.TarInfo(m)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    (tmp_path / "d.tar").write_bytes(b"broken" * 50)
    (tmp_path / "e.zip").write_bytes(b"")  # the reader passes over empty files
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("only.txt", b"")
    got = {(r.path.rsplit("/", 1)[1], r.member, r.size, r.status) for r in archive_members(spark, f"{tmp_path}/*", r"\.(mtx|tsv)(\.gz)?$").collect()}
    assert got == {("a.zip", "x/barcodes.tsv.gz", 3, "ok"), ("b.tar.gz", "y/matrix.mtx", 3000, "ok"), ("c.zip", "y/matrix.mtx", 3000, "ok"), ("d.tar", None, None, "error: ReadError"), ("f.zip", None, None, "no_useful_members")}
    one = archive_members(spark, f"{tmp_path}/a.zip", "barcodes").first()
    assert bytes(one.content) == b"one" and archive_members(spark, f"{tmp_path}/a.zip", "barcodes", content=False).first().content is None
