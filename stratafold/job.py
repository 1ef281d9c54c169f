"""Command line: one PDF or a folder of them, recognised from its path, processed with the engine's review and exported."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from stratafold.sources.locks import acquire, release


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Turns technical PDF documents into typed, traceable tables.")
    parser.add_argument("--input", required=True, help="a PDF file")
    parser.add_argument("--output", default="output", help="output root")
    return parser.parse_args(argv)


def folders_under_input(path: Path) -> tuple[str, ...]:
    """Folders of a path after its first part named input, in whatever case."""
    low = [p.lower() for p in path.parts]
    return tuple(p for p in path.parts[low.index("input") + 1 : -1] if p not in ("", ".")) if "input" in low else ()


def output_folder(path: Path, root: Path) -> Path:
    return root.joinpath(*folders_under_input(path), path.stem)


def main(argv: list[str] | None = None, process=None) -> int:
    """0 if the file was processed, 1 if it is missing, no PDF, or its output folder is in use. process(path, folder) does
    the work and returns lines to print."""
    given = arguments(argv)
    path = Path(given.input)
    if not path.exists():
        print(f"no such file: {path}", file=sys.stderr)
        return 1
    if path.suffix.lower() != ".pdf":
        print("only PDF files can be processed", file=sys.stderr)
        return 1
    folder = output_folder(path, Path(given.output))
    held = acquire(str(folder))
    if held:
        print(held, file=sys.stderr)
        return 1
    try:
        for line in (process(path, folder) if process else []):
            print(line)
    finally:
        release(str(folder))
    return 0


if __name__ == "__main__":
    sys.exit(main())
