"""Representations as objects: how a set is encoded, how stored examples are read, and how they are decoded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from scoreloom.model import ATTRIBUTES, SeqSet
from scoreloom.operators import represent


class Representation(Protocol):
    """What a user's own representation has to offer. Examples are rows with ``seq_id`` and features."""

    def encode(self, seqs: SeqSet) -> DataFrame: ...

    def parse(self, examples: DataFrame, **options) -> DataFrame: ...

    def decode(self, examples: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class PitchSequence:
    """One token per step, with the attributes as context if they are kept.

    The sequence length is not applied to what is encoded, unless ``pad`` is set; parsing tokens checks it.
    ``chunk_steps`` stores longer sequences in several rows.
    """

    sequence_length: int
    keep_attributes: bool = False
    pad: bool = False
    attributes: Sequence[str] = ATTRIBUTES
    chunk_steps: int | None = None

    def encode(self, seqs: SeqSet) -> DataFrame:
        length = self.sequence_length if self.pad else None
        if self.keep_attributes:
            return represent.encode_with_context(seqs, self.attributes, length, chunk_steps=self.chunk_steps)
        return represent.encode(seqs, length, chunk_steps=self.chunk_steps)

    def parse(
        self,
        examples: DataFrame,
        attributes_to_parse: Sequence[str] | None = None,
        default_attributes_value: float | None = None,
        parse_sequence_feature: bool = False,
    ) -> DataFrame:
        """Chosen features. With the tokens, only examples of the sequence length; ``misfits`` has the others."""
        if parse_sequence_feature:
            examples = represent.fixed_length(examples, self.sequence_length)[0]
        return represent.parse(examples, attributes_to_parse, default_attributes_value, parse_sequence_feature)

    def misfits(self, examples: DataFrame) -> DataFrame:
        return represent.fixed_length(examples, self.sequence_length)[1]

    def decode(self, examples: DataFrame) -> DataFrame:
        return represent.decode(examples, self.chunk_steps)

    def decode_sequences(self, examples: DataFrame) -> SeqSet:
        """Notes, and headers with the attributes that the examples keep."""
        return represent.decode_sequences(examples, self.chunk_steps)
