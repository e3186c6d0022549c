"""Files on any filesystem Arrow knows (local or shared mounts, hdfs://, s3://, gs://)."""

import os

from pyarrow import fs

READ_BYTES = 8 << 20


def resolve(path):
    if "://" not in path and not path.startswith("file:"):
        path = os.path.abspath(path)
    elif path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def sizes(folder):
    """{name: size} of the files directly below a folder (or of the one file named)."""
    store, base = resolve(folder)
    info = store.get_file_info(base)
    if info.type == fs.FileType.File:
        return {base.rsplit("/", 1)[-1]: info.size}, base.rsplit("/", 1)[0]
    listed = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return {i.base_name: i.size for i in listed if i.type == fs.FileType.File}, base


class Blocks:
    """Sequential reads of [start, end) of a file through a small buffer."""

    def __init__(self, store, path, start, end):
        self.file = store.open_input_file(path)
        self.file.seek(start)
        self.pos, self.end = start, min(end, self.file.size())
        self.buf, self.at = b"", 0

    def take(self, n):
        """The next n bytes, or None when fewer are left."""
        if len(self.buf) - self.at < n:
            rest = self.buf[self.at :]
            want = min(max(READ_BYTES, n - len(rest)), self.end - self.pos)
            more = self.file.read(want) if want > 0 else b""
            self.pos += len(more)
            self.buf, self.at = rest + more, 0
            if len(self.buf) < n:
                return None
        out = self.buf[self.at : self.at + n]
        self.at += n
        return out

    def close(self):
        self.file.close()
