"""Sources: what files they have and how to read them. Columns are all strings; meaning comes with the mapping."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

# Files and columns of the film source.
COLUMNS = {
    "name.basics.tsv.gz": ("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
    "title.akas.tsv.gz": ("titleId", "ordering", "title", "region", "language", "types", "attributes", "isOriginalTitle"),
    "title.basics.tsv.gz": ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear", "endYear", "runtimeMinutes", "genres"),
    "title.crew.tsv.gz": ("tconst", "directors", "writers"),
    "title.episode.tsv.gz": ("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
    "title.ratings.tsv.gz": ("tconst", "averageRating", "numVotes"),
}

#: How the files are written: no quoting, so a lone quote is only a character.
DIALECT = {"sep": "\t", "header": "true", "quote": "", "escape": "", "nullValue": "\\N", "mode": "PERMISSIVE", "encoding": "UTF-8"}


@dataclass(frozen=True)
class Source:
    id: str
    label: str
    columns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    pattern: str = "*.tsv.gz"

    def schema(self, file: str) -> str:
        return ", ".join(f"`{c}` string" for c in self.columns[file])


SOURCES = {"imdb": Source("imdb", "IMDb non-commercial datasets", COLUMNS)}


def register(source: Source) -> None:
    SOURCES[source.id] = source


def missing(found: Iterable[str], expected: Iterable[str]) -> list[str]:
    return sorted(set(expected) - set(found))


def discover(source: Source, folder: Path) -> list[Path]:
    """The source's files in name order, further ones included; an error if the folder or an expected file isn't there."""
    if not folder.is_dir():
        raise FileNotFoundError(f"{folder} is no folder")
    files = sorted(folder.glob(source.pattern))
    if lacking := missing((f.name for f in files), source.columns):
        raise FileNotFoundError(f"{folder} lacks {', '.join(lacking)}")
    return files
