"""Run settings, with an XML round trip, command-line defaults and checks."""

from __future__ import annotations

import argparse
import os
import shutil
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass
class RunConfig:
    """Settings of a discovery run. Paths are those of Spark's readers; a null segment length is found from the data."""

    reads1: str = ""
    reads2: str = ""
    transcripts: str = ""
    output: str = ""
    library: str = "fr-unstranded"
    quality: str = "sanger"
    trim5: int = 0
    trim3: int = 0
    min_isize: int = 0
    max_isize: int = 1000
    isize_mean: float = 200.0
    isize_sd: float = 40.0
    min_isize_samples: int = 100
    max_isize_samples: int = 5_000_000
    max_multihits: int = 1
    segment_length: int | None = None
    anchor: int = 12
    min_frags: int = 2
    min_fraction: float = 0.0
    best_pairs: str = "best"
    source: str = "ensembl"
    mask_biotypes: list[str] = field(default_factory=list)
    mask_rnames: list[str] = field(default_factory=list)

    def to_xml(self) -> str:
        root = ET.Element("run")
        for f in fields(self):
            value = getattr(self, f.name)
            for v in value if isinstance(value, list) else [value]:
                if v is not None:
                    ET.SubElement(root, f.name).text = str(v)
        ET.indent(root)
        return ET.tostring(root, encoding="unicode")

    @classmethod
    def from_xml(cls, text: str) -> RunConfig:
        out, root = cls(), ET.fromstring(text)
        for f in fields(cls):
            found = [x.text or "" for x in root.findall(f.name)]
            if f.name.startswith("mask_"):
                setattr(out, f.name, found)
            elif found:
                setattr(out, f.name, _cast(f.type, found[-1]))
            elif "None" in str(f.type):
                setattr(out, f.name, None)
        return out

    @classmethod
    def from_args(cls, argv: list[str], base: RunConfig | None = None) -> RunConfig:
        """Command-line values, where given, over those of ``base``."""
        parser = argparse.ArgumentParser()
        for f in fields(cls):
            parser.add_argument(f"--{f.name.replace('_', '-')}", **({"action": "append"} if f.name.startswith("mask_") else {}))
        out = base or cls()
        for name, v in vars(parser.parse_args(argv)).items():
            if v is not None:
                setattr(out, name, v if isinstance(v, list) else _cast(next(f.type for f in fields(cls) if f.name == name), v))
        return out

    def problems(self, read_lengths: tuple[int, int] | None = None, *, spark=None, programs: list[str] | tuple[str, ...] = ()) -> list[str]:
        """What is wrong with the settings; empty if nothing is.

        With a session the inputs that are named are looked for in their file systems; ``programs``
        are looked for on the path of this machine.
        """
        found = [f"{name} isn't there" for name in unreachable(spark, [p for p in (self.reads1, self.reads2, self.transcripts) if p])] if spark is not None else []
        found += [f"program {name} isn't found or can't be run" for name in missing_binaries(list(programs))]
        if bool(self.reads1) != bool(self.reads2):
            found.append("reads of one mate only")
        if not 0 <= self.min_isize <= self.max_isize:
            found.append("insert sizes out of order")
        if not 0 < self.min_isize_samples <= self.max_isize_samples:
            found.append("insert size samples out of order")
        if self.library not in ("fr-unstranded", "fr-firststrand", "fr-secondstrand"):
            found.append(f"unknown library type {self.library}")
        if self.quality not in ("sanger", "illumina", "solexa"):
            found.append(f"unknown quality format {self.quality}")
        if self.anchor < 12:
            found.append("anchor under 12")
        if self.best_pairs not in ("best", "all"):
            found.append("best_pairs is best or all")
        if read_lengths:
            trimmed = min(read_lengths) - self.trim5 - self.trim3
            if read_lengths[0] != read_lengths[1]:
                found.append("mates differ in length")
            if trimmed < 25:
                found.append(f"trimmed reads of {trimmed} bases: 25 at least")
            if self.segment_length is not None and not 25 <= self.segment_length <= trimmed:
                found.append("segment length outside 25 to the trimmed read")
        return found


def _cast(kind, text: str):
    kind = str(kind)
    return int(text) if kind.startswith("int") else float(text) if kind.startswith("float") else text


def unreachable(spark, paths: list[str]) -> list[str]:
    """Inputs and index files that aren't there, asked of the file system of each path."""
    jvm, conf, missing = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(conf).exists(where):
            missing.append(path)
    return missing


def missing_binaries(names: list[str]) -> list[str]:
    """External programs that aren't found on the path, or aren't executable."""
    return [n for n in names if shutil.which(n) is None]


def up_to_date(output: str, inputs: list[str]) -> bool:
    """Whether a local output exists, isn't empty and is no older than its inputs."""
    p = Path(output)
    if not p.exists() or (p.is_file() and not p.stat().st_size):
        return False
    return all(os.path.getmtime(i) <= p.stat().st_mtime for i in inputs)
