"""File systems that tasks open themselves, through Arrow."""
from collections.abc import Callable


def opener(folder: str) -> Callable[[], tuple]:
    """A function for the tasks that gives the file system of ``folder`` and the path in it.

    A closure, so that it travels to the workers by value.
    """
    where = folder if "://" in folder else folder.removeprefix("file:")

    def open_system() -> tuple:
        from pyarrow import fs

        return fs.FileSystem.from_uri(where)

    return open_system


def tasks_open(folder: str) -> bool:
    """Whether Arrow opens the path: mounted folders, ``hdfs`` with its native library, ``s3``, ``gs``."""
    try:
        opener(folder)()
    except Exception:  # Arrow has no common class for schemes and libraries it lacks
        return False
    return True
