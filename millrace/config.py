"""Job options: names, defaults and the `input-` / `output-` prefixes."""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from millrace.functions.avro_schema import Decoder, parse_avro_schema
from millrace.sources.events import Cut, parse_cut


def parse_arguments(arguments: Sequence[str]) -> dict[str, str]:
    """`--name value` pairs; a name without a value is a switch."""
    options: dict[str, str] = {}
    name = None
    for argument in arguments:
        is_name = argument.startswith("-") and not _is_number(argument)
        if is_name:
            name = argument.lstrip("-")
            if not name:
                raise ValueError(f"not an option name: {argument!r}")
            options[name] = "true"
        elif name is None:
            raise ValueError(f"expected an option name, not {argument!r}")
        else:
            options[name] = argument
            name = None
    return options


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def _flag(text: str) -> bool:
    return text.strip().lower() == "true"


@dataclass(frozen=True)
class StreamOptions:
    """Where a stream lies and which part of it to read."""

    path: str
    start_at_tail: bool
    end_at_tail: bool
    start_cut: Cut | None
    end_cut: Cut | None
    segments: int


class Options:
    """The options of one job."""

    def __init__(self, values: Mapping[str, str]):
        self.values = {name: str(value) for name, value in values.items()}

    @classmethod
    def from_arguments(cls, arguments: Sequence[str]) -> Options:
        return cls(parse_arguments(arguments))

    def get(self, name: str, default: str = "") -> str:
        return self.values.get(name, default)

    def required(self, name: str) -> str:
        if not self.get(name):
            raise ValueError(f"option --{name} is required")
        return self.get(name)

    def flag(self, name: str, default: bool = False) -> bool:
        return _flag(self.get(name, str(default)))

    def integer(self, name: str, default: int) -> int:
        return int(self.get(name, str(default)))

    def number(self, name: str, default: float) -> float:
        return float(self.get(name, str(default)))

    def stream(self, prefix: str) -> StreamOptions:
        """Options of the `input` or `output` stream: `input-startAtTail` wins over `startAtTail`."""

        def of(name: str, default: str = "") -> str:
            return self.get(f"{prefix}-{name}", self.get(name, default))

        return StreamOptions(
            path=self.required(f"{prefix}-stream"),
            start_at_tail=_flag(of("startAtTail", "false")),
            end_at_tail=_flag(of("endAtTail", "false")),
            start_cut=parse_cut(of("startStreamCut")),
            end_cut=parse_cut(of("endStreamCut")),
            segments=int(of("minNumSegments", "1")),
        )

    def avro_schema(self, read_file) -> Decoder:
        """The record schema, from base64 text or else from a file that `read_file` can read."""
        encoded = self.get("avroSchema")
        if encoded:
            text = base64.b64decode(encoded).decode("utf-8")
        elif self.get("avroSchemaFile"):
            text = read_file(self.get("avroSchemaFile"))
        else:
            raise ValueError("an Avro schema is required: set --avroSchema or --avroSchemaFile")
        return parse_avro_schema(text)

    @property
    def keys(self) -> str:
        return self.get("keyFieldNames")

    @property
    def counter(self) -> str:
        return self.get("counterFieldName")
