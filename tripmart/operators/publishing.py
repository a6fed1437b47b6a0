"""Publishing files so that a crash leaves all of a load or nothing of it.

What a load has written lies in a folder beside its table until it is complete.  Then one small file,
the intent, is put in place by a rename; it lists what goes where.  From then on the load is
done: after a crash the listed steps are taken again.  Without an intent nothing has happened.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

# (what replaces a target, or None if it only goes; the target)
Step = tuple[str | None, str]


class Files:
    """The few file operations that loads need, on whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def system(self, text: str):
        return self.path(text).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, text: str) -> bool:
        return self.system(text).exists(self.path(text))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if there is no folder."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self.system(folder).listStatus(self.path(folder))]

    def delete(self, text: str) -> None:
        self.system(text).delete(self.path(text), True)

    def make_folder(self, text: str) -> None:
        self.system(text).mkdirs(self.path(text))

    def rename(self, source: str, target: str) -> None:
        if not self.system(target).rename(self.path(source), self.path(target)):
            raise OSError(f"could not move {source} to {target}")

    def read_text(self, text: str) -> str | None:
        if not self.exists(text):
            return None
        stream = self.system(text).open(self.path(text))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, text: str, content: str) -> None:
        """Write a small file that is seen whole or not at all."""
        draft = f"{text}.draft"
        stream = self.system(draft).create(self.path(draft), True)
        stream.write(bytearray(content.encode()))
        stream.close()
        self.delete(text)
        self.rename(draft, text)


def publish(
    files: Files,
    intent: str,
    steps: Sequence[Step],
    leftovers: Sequence[str] = (),
    before_step: Callable[[int], None] = lambda n: None,
) -> None:
    """Take all steps, or none if the intent cannot be written."""
    files.write_text(intent, json.dumps({"steps": list(steps), "leftovers": list(leftovers)}))
    _finish(files, intent, before_step)


def recover(files: Files, intent: str) -> bool:
    """Finish what an earlier process has begun to publish; whether there was anything."""
    if not files.exists(intent):
        return False
    _finish(files, intent, lambda n: None)
    return True


def _finish(files: Files, intent: str, before_step: Callable[[int], None]) -> None:
    listed = json.loads(files.read_text(intent))
    for number, (source, target) in enumerate(listed["steps"]):
        before_step(number)
        if source is None:
            files.delete(target)
        elif files.exists(source):  # else this step was taken before the crash
            files.delete(target)
            files.make_folder(target.rsplit("/", 1)[0])
            files.rename(source, target)
    for folder in listed["leftovers"]:
        files.delete(folder)
    files.delete(intent)
