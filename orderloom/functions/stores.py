"""Files of any store that both Spark and Arrow know, for tasks that need random access."""

from __future__ import annotations

from urllib.parse import quote


def store_of(uri: str):
    """Arrow file system and inner path of an address: a bare path, ``file:/…``, ``s3a://…`` and so on."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    # Spark gives paths as plain text; an address needs its odd characters quoted.
    return fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe=":/@"))


def newest_batch(path: str) -> int:
    """The greatest N of the finished folders ``batch=N`` under a path; -1 if there is none."""
    from pyarrow import fs

    store, inner = store_of(path)
    done = [-1]
    for info in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        name, _, number = info.base_name.partition("=")
        if name == "batch" and store.get_file_info(f"{info.path}/_SUCCESS").type == fs.FileType.File:
            done.append(int(number))
    return max(done)
