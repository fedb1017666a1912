from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kessan.schema import FACT_FILE_COLUMNS  # noqa: E402
from kessan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Corpus:
    """Hand-made fact files under ``annual/{entity}/{doc}.tsv``."""

    def __init__(self, root: Path):
        self.root = root

    def add(self, entity: str, doc: str, rows: list[dict], extra_lines: tuple[str, ...] = ()) -> None:
        folder = self.root / "annual" / entity
        folder.mkdir(parents=True, exist_ok=True)
        lines = ["\t".join(f'"{name}"' for name in FACT_FILE_COLUMNS)]
        for row in rows:
            cells = [row.get(name) for name in FACT_FILE_COLUMNS.values()]
            lines.append("\t".join("" if c is None else '"' + c.replace('"', '""') + '"' for c in cells))
        text = "\r\n".join([*lines, *extra_lines]) + "\r\n"
        (folder / f"{doc}.tsv").write_bytes(text.encode("utf-16"))

    @property
    def pattern(self) -> str:
        return str(self.root / "annual" / "*")


@pytest.fixture
def corpus(tmp_path):
    return Corpus(tmp_path)
