"""Operators on hand-written cases."""

from __future__ import annotations

import pytest
from build import grid, n, rows, seqset
from pyspark.sql import functions as F

from scoreloom.operators import attributes, augment, distinct, melody, quantize, represent, slicing, split, transform
from scoreloom.operators import histogram as hist


def tempo(id, time, qpm):
    return {"id": id, "kind": "tempo", "time": time, "qpm": float(qpm)}


def signature(id, time, num, den):
    return {"id": id, "kind": "time_signature", "time": time, "num": num, "den": den}


def pedal(id, time, value, instrument=0):
    return {"id": id, "kind": "control", "time": time, "cc_number": 64, "cc_value": value, "instrument": instrument}


# Quantize


def test_quantize_rounds_half_up_and_keeps_a_step(spark):
    seqs = seqset(spark, [n("a", 0.0, 0.01, 60), n("a", 0.0625, 0.3, 61)], [tempo("a", 0, 120)])
    done = quantize.quantize(seqs, 4)
    assert rows(done.notes, "pitch", "q_start", "q_end", "total_steps") == [(60, 0, 1, 2), (61, 1, 2, 2)]


def test_quantize_takes_exactly_one_grid(spark):
    seqs = seqset(spark, [n("a", 0, 1, 60)])
    with pytest.raises(ValueError):
        quantize.quantize(seqs, None, None)
    with pytest.raises(ValueError):
        quantize.quantize(seqs, 4, 10)


def test_quantize_discard_reasons_have_an_order(spark):
    notes = [n(i, -1 if i in "de" else 0, 1, 60) for i in "abcdef"]
    events = [
        signature("a", 0, 4, 4), signature("a", 5, 3, 4), tempo("a", 0, 60), tempo("a", 5, 90),
        tempo("b", 0, 60), tempo("b", 5, 90), signature("b", 0, 4, 3),
        signature("c", 0, 4, 3),
        signature("d", 0, 4, 4), signature("d", 3, 4, 4),
        signature("f", 0, 0, 4),
    ]
    seqs = seqset(spark, notes, events)
    assert rows(quantize.discards(seqs), "seq_id", "reason") == [
        ("a", "multiple_time_signatures"),
        ("b", "multiple_tempos"),
        ("c", "bad_time_signature"),
        ("d", "negative_time"),
        ("e", "negative_time"),
        ("f", "bad_time_signature"),
    ]
    assert quantize.quantize(seqs).notes.count() == 0
    assert rows(quantize.discards(seqs, None, 10), "seq_id") == [("d",), ("e",)]


# Split


def test_hop_clips_and_rebases(spark):
    seqs = seqset(spark, [n("a", 0.5, 2.5, 60), n("a", 1.0, 1.5, 61), n("a", 3.0, 3.5, 62)])
    done = split.split_hop(seqs, hop_size_seconds=1.0, hop_size_bars=None)
    assert rows(done.notes, "seq_id", "pitch", "start_time", "end_time") == [
        ("a#split@0", 60, 0.5, 1.0),
        ("a#split@1000000", 61, 0.0, 0.5),
        ("a#split@3000000", 62, 0.0, 0.5),
    ]
    assert rows(done.sequences, "seq_id", "parent_id", "start_offset") == [
        ("a#split@0", "a", 0.0),
        ("a#split@1000000", "a", 1.0),
        ("a#split@3000000", "a", 3.0),
    ]


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_hop_skips_cuts_inside_notes(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    # The cuts at 1 and 2 fall inside the first note; the one at 3 touches its end and is kept.
    seqs = seqset(spark, [n("a", 0.5, 3.0, 60), n("a", 1.5, 1.75, 61), n("a", 3.0, 3.5, 62), n("a", 9.0, 9.5, 63)])
    done = split.split_hop(seqs, hop_size_seconds=1.0, hop_size_bars=None, skip_splits_inside_notes=True)
    assert rows(done.notes, "seq_id", "pitch", "start_time", "end_time") == [
        ("a#split@0", 60, 0.5, 3.0),
        ("a#split@0", 61, 1.5, 1.75),
        ("a#split@3000000", 62, 0.0, 0.5),
        ("a#split@9000000", 63, 0.0, 0.5),
    ]


def test_hop_takes_exactly_one_size(spark):
    seqs = seqset(spark, [n("a", 0, 1, 60)])
    with pytest.raises(ValueError):
        split.split_hop(seqs, hop_size_seconds=1.0, hop_size_bars=2)


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_silence_needs_more_than_the_gap(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    # A long early note bridges later ones; a rest of exactly three seconds does not cut.
    notes = [n("a", 0, 10, 60), n("a", 1, 2, 61), n("a", 13, 14, 62), n("a", 17.5, 18, 63), n("b", 5, 6, 64)]
    done = split.split_silence(seqset(spark, notes), 3.0)
    assert rows(done.notes, "seq_id", "pitch", "start_time") == [
        ("a#silence@0", 60, 0.0),
        ("a#silence@0", 61, 1.0),
        ("a#silence@0", 62, 13.0),
        ("a#silence@17500000", 63, 0.0),
        ("b#silence@5000000", 64, 0.0),
    ]


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_time_changes_cut_only_where_a_value_changes(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    events = [
        tempo("a", 0, 60), signature("a", 0, 4, 4), tempo("a", 4, 60), tempo("a", 8, 90), signature("a", 12, 3, 4),
        tempo("b", 6, 100),
    ]
    notes = [n("a", 1, 9, 60), n("a", 8, 9, 61), n("a", 13, 14, 62), n("b", 1, 2, 63), n("b", 7, 8, 64), n("c", 0, 1, 65)]
    done = split.split_time_changes(seqset(spark, notes, events), keep_time_signatures=None)
    assert rows(done.notes, "seq_id", "pitch", "start_time", "end_time", "qpm") == [
        ("a#change@0", 60, 1.0, 8.0, 60.0),
        ("a#change@12000000", 62, 1.0, 2.0, 90.0),
        ("a#change@8000000", 61, 0.0, 1.0, 90.0),
        ("b#change@0", 63, 1.0, 2.0, 120.0),
        ("b#change@6000000", 64, 1.0, 2.0, 100.0),
        ("c#change@0", 65, 0.0, 1.0, 120.0),
    ]
    kept = split.split_time_changes(seqset(spark, notes, events))
    assert sorted(r[0] for r in rows(kept.sequences, "seq_id")) == [
        "a#change@0", "a#change@8000000", "b#change@0", "b#change@6000000", "c#change@0",
    ]
    quantized = quantize.quantize(kept)
    assert rows(quantized.notes, "pitch", "q_start") == [(60, 4), (61, 0), (63, 8), (64, 7), (65, 0)]
    # Without the columns kept on the notes the handed-on events must lead to the same grid.
    bare = kept.with_(notes=kept.notes.drop("qpm", "num", "den"))
    assert rows(quantize.quantize(bare).notes, "pitch", "q_start") == rows(quantized.notes, "pitch", "q_start")


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_time_changes_can_skip_cuts_inside_notes(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    notes = [n("a", 1, 9, 60), n("a", 8, 9, 61), n("a", 12, 13, 62)]
    events = [tempo("a", 0, 60), tempo("a", 8, 90), tempo("a", 12, 80)]
    done = split.split_time_changes(seqset(spark, notes, events), True, None)
    assert rows(done.notes, "seq_id", "pitch") == [("a#change@0", 60), ("a#change@0", 61), ("a#change@12000000", 62)]


# Slices


def test_slices_overlap_and_count_short_ones(spark):
    seqs = grid(spark, [n("a", 0, 4, 60), n("a", 20, 24, 61), n("a", 40, 44, 62)])
    options = {"slice_size_bars": 2, "hop_size_bars": 1, "allow_cropped_slices": True}
    done = slicing.slice_bars(seqs, **options)
    assert rows(done.notes, "seq_id", "pitch", "q_start", "total_steps") == [
        ("a#slice0", 60, 0, 32),
        ("a#slice0", 61, 20, 32),
        ("a#slice1", 61, 4, 32),
        ("a#slice1", 62, 24, 32),
        ("a#slice2", 62, 8, 16),
    ]
    assert slicing.shorter_slices(seqs, **options).first()[0] == 1
    kept = slicing.slice_bars(seqs, **options, keep_shorter_slices=False)
    assert rows(kept.sequences, "seq_id") == [("a#slice0",), ("a#slice1",)]


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_slices_that_cut_notes(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    seqs = grid(spark, [n("a", 10, 20, 60), n("a", 20, 24, 61), n("a", 32, 48, 62)])
    options = {"slice_size_bars": 1, "hop_size_bars": 1}
    ids = lambda **o: [r[0] for r in rows(slicing.slice_bars(seqs, **options, **o).notes, "seq_id")]
    assert ids(allow_cropped_slices=True) == ["a#slice0", "a#slice1", "a#slice2"]
    assert ids() == ["a#slice1", "a#slice2"]
    assert ids(skip_splits_inside_notes=True) == ["a#slice2"]
    cropped = slicing.slice_bars(seqs, **options, allow_cropped_slices=True)
    assert rows(cropped.notes, "seq_id", "q_start", "q_end")[0] == ("a#slice0", 10, 16)


def test_slices_with_gaps_between_them(spark):
    seqs = grid(spark, [n("a", 0, 1, 60), n("a", 17, 18, 61), n("a", 33, 34, 62)])
    done = slicing.slice_bars(seqs, slice_size_bars=1, hop_size_bars=2, allow_cropped_slices=True)
    assert rows(done.notes, "seq_id", "pitch") == [("a#slice0", 60), ("a#slice1", 62)]
    later = slicing.slice_bars(seqs, slice_size_bars=1, hop_size_bars=1, start_time=16, allow_cropped_slices=True)
    assert rows(later.notes, "seq_id", "pitch", "q_start") == [("a#slice0", 61, 1), ("a#slice1", 62, 1)]


# Melody


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_melody_top_note_truncation_and_gap(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    notes = [
        n("a", 2, 10, 60), n("a", 2, 6, 64), n("a", 4, 8, 62), n("a", 20, 30, 65),  # top note at 2, cut at 4
        n("a", 46, 50, 67), n("a", 48, 60, 69), n("a", 62, 64, 71),                 # a rest of exactly one bar: new melody
        n("a", 0, 4, 40, drum=True), n("a", 0, 4, 10), n("a", 1, 4, 70, program=120),
    ]
    seqs = grid(spark, notes)
    done = melody.extract_melodies(seqs, min_bars=1, min_unique_pitches=1)
    assert rows(done.notes, "seq_id", "q_start", "q_end", "pitch", "total_steps") == [
        ("a#melody0@0", 2, 4, 64, 30),
        ("a#melody0@0", 20, 30, 65, 30),
        ("a#melody0@0", 4, 8, 62, 30),
        ("a#melody0@32", 14, 16, 67, 32),
        ("a#melody0@32", 16, 28, 69, 32),
        ("a#melody0@32", 30, 32, 71, 32),
    ]
    audit = dict(rows(melody.melody_audit(seqs, min_bars=3), "metric", "value"))
    assert audit == {"melodies_discarded_too_short": 2}
    polyphonic = melody.extract_melodies(seqs, min_bars=1, min_unique_pitches=1, ignore_polyphonic_notes=False)
    assert polyphonic.notes.count() == 0
    audit = dict(rows(melody.melody_audit(seqs, ignore_polyphonic_notes=False), "metric", "value"))
    assert audit == {"polyphonic_tracks_discarded": 1}


def test_melody_truncates_discards_and_counts_pitches(spark):
    notes = [n("a", 16 * i, 16 * i + 16, 60 + i) for i in range(6)]
    seqs = grid(spark, notes)
    cut = melody.extract_melodies(seqs, max_bars_truncate=4)
    assert rows(cut.notes.agg(F.count("*"), F.max("q_end"), F.max("total_steps")), "*") == [(4, 64, 64)]
    assert melody.extract_melodies(seqs, max_bars_discard=5).notes.count() == 0
    assert melody.extract_melodies(seqs, max_bars_truncate=2).notes.count() == 0  # two pitches are too few
    counts = lambda **o: dict(rows(melody.melody_audit(seqs, **o), "metric", "value"))
    assert counts(max_bars_truncate=4) == {"output_sequences": 1, "melodies_truncated": 1}
    assert counts(max_bars_discard=5) == {"melodies_discarded_too_long": 1}
    assert rows(melody.melody_lengths(seqs), "bars", "count") == [(6, 1)]


def test_melody_needs_whole_steps_per_bar(spark):
    seqs = grid(spark, [n("a", i, i + 1, 60 + i) for i in range(8)], steps_per_bar=1.5)
    assert melody.extract_melodies(seqs).notes.count() == 0
    assert dict(rows(melody.melody_audit(seqs), "metric", "value")) == {"non_integer_steps_per_bar_tracks_discarded": 1}


# Transforms


def test_stretch(spark):
    seqs = seqset(spark, [n("a", 1, 2, 60)], [tempo("a", 4, 120)])
    done = transform.stretch(seqs, 2.0)
    assert rows(done.notes, "start_time", "end_time") == [(2.0, 4.0)]
    assert rows(done.events, "time", "qpm") == [(8.0, 60.0)]
    with pytest.raises(ValueError):
        transform.stretch(quantize.quantize(seqs), 2.0)


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_sustain(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    notes = [
        n("a", 0, 1, 60),                      # before the pedal
        n("a", 1, 3, 62),                      # released at 6
        n("a", 2, 4, 64), n("a", 5, 5.5, 64),  # struck again at 5, then released
        n("a", 2, 3, 62, instrument=1),        # another instrument
        n("a", 6, 7, 65),                      # pedal up
        n("a", 18, 19, 67), n("a", 19, 25, 69),  # never released: to the end at 25
    ]
    events = [pedal("a", 2, 64), pedal("a", 2.5, 100), pedal("a", 6, 63), pedal("a", 17, 127)]
    done = transform.sustain(seqset(spark, notes, events))
    assert rows(done.notes, "note_idx", "end_time") == [
        (0, 1.0), (1, 6.0), (2, 5.0), (3, 6.0), (4, 3.0), (5, 7.0), (6, 25.0), (7, 25.0),
    ]


def test_transpose(spark):
    notes = [n("a", 0, 1, 60), n("a", 0, 1, 107), n("a", 0, 1, 50, drum=True), n("b", 0, 1, 108)]
    chords = [{"id": "a", "kind": "chord", "time": 0, "text": t} for t in ("C", "Bbm7", "N.C.", "F#")]
    seqs = seqset(spark, notes, chords)
    done = transform.transpose(seqs, amount=2, min_allowed_pitch=21, max_allowed_pitch=108)
    assert rows(done.notes, "seq_id", "pitch") == [("a", 50), ("a", 62)]
    assert rows(done.sequences, "seq_id") == [("a",)]
    assert sorted(r[0] for r in rows(done.events, "text")) == ["Cm7", "D", "G#", "N.C."]
    strict = transform.transpose(seqs, amount=2, max_allowed_pitch=108, delete_notes=False)
    assert strict.notes.count() == 0
    there = transform.transpose(seqs, amount=5)
    back = transform.transpose(there, amount=-5)
    assert rows(back.notes, "note_idx", "pitch") == rows(seqs.notes, "note_idx", "pitch")
    audit = transform.transpose_audit(seqs, amount=2, max_allowed_pitch=108).first()
    assert (audit["skipped_due_to_range_exceeded"], audit["transpositions_generated"]) == (1, 1)
    assert (audit["deleted_count"], audit["deleted_sum"]) == (2, 2)


# Attributes


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_attributes_by_hand(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    notes = [
        n("a", 0, 4, 60, velocity=10), n("a", 4, 12, 60, velocity=70), n("a", 8, 10, 60), n("a", 12, 14, 60),
        n("a", 12, 13, 50), n("a", 20, 24, 64), n("a", 30, 31, 62, velocity=100),
    ]
    table = attributes.attribute_table(grid(spark, notes, total_steps=32)).first().asDict()
    assert table == {
        "seq_id": "a",
        # Weights 5 (0), 3 (4), 4 (8), 3 (12), 3 (20) and 2 (30) of 2 x 31; cells 6 of 32.
        "toussaint": round(20 / 62, 5),
        "note_density": round(6 / 32, 5),
        "pitch_range": round(4 / 88, 5),
        "contour": round(2 / 5 / 88, 5),
        "unique_notes_ratio": round(3 / 6, 5),
        "unique_bigrams_ratio": round(3 / 5, 5),
        "unique_trigrams_ratio": round(3 / 4, 5),
        "dynamic_range": round(90 / 127, 5),
        "note_change_ratio": round(2 / 5, 5),
        # Sounding 4 + 4 + 2 + 2 + 4 + 1 = 17 of 32 steps, 6 of them onsets.
        "ratio_note_off_steps": round(15 / 32, 5),
        "ratio_hold_note_steps": round(11 / 32, 5),
        "repetitive_section_ratio": round(4 / 6, 5),
        "len_longest_rep_section": 4.0,
    }


def test_attributes_of_a_single_note_and_of_none(spark):
    seqs = grid(spark, [n("a", 3, 5, 60)], ids=["a", "empty"])
    done = attributes.compute_attributes(seqs)
    single = done.sequences.filter("seq_id = 'a'").first()
    assert (single["contour"], single["unique_bigrams_ratio"], single["len_longest_rep_section"]) == (0.0, 0.0, 0.0)
    assert done.sequences.filter("seq_id = 'empty'").first()["contour"] is None
    counts = hist.histogram(done.sequences, ["contour"], [4])
    assert rows(counts, "bin", "lo", "hi", "count") == [
        (0, -0.5, -0.25, 0), (1, -0.25, 0.0, 0), (2, 0.0, 0.25, 2), (3, 0.25, 0.5, 0),
    ]


def test_toussaint_of_bars_without_an_onset(spark):
    """A sequence that starts after the bars that are weighed, as user 1378 of sf0.1 does: SQL sums nothing there."""
    seqs = grid(spark, [n("late", 64, 66, 60), n("in time", 63, 66, 60)], total_steps=80)
    table = attributes.attribute_table(seqs, {"toussaint": {"bars": 4}, "note_density": {"bars": 4}})
    assert rows(table, "seq_id", "toussaint", "note_density") == [("in time", 0.00806, 0.01563), ("late", None, 0.0)]


def test_attribute_options(spark):
    seqs = grid(spark, [n("a", 0, 1, 60), n("a", 1, 2, 61), n("a", 2, 3, 61)])
    one = attributes.attribute_table(seqs, {"note_change_ratio": {"round_digits": 1, "order": 3}})
    assert rows(one, "*") == [("a", 0.5)]
    with pytest.raises(ValueError):
        attributes.attribute_table(seqs, {"note_change_ratio": {"bars": 1}})
    with pytest.raises(ValueError):
        attributes.attribute_table(seqs, ["tonality"])
    with pytest.raises(ValueError):
        attributes.attribute_table(seqset(spark, [n("a", 0, 1, 60)]))


# Augment and split


def test_clamped_amounts_stay_in_the_band(spark):
    notes = [n(f"s{i}", 0, 1, p) for i in range(60) for p in (23, 100 + i % 8)]
    seqs = seqset(spark, notes, ids=["empty"])
    done = augment.augment_transpose(seqs, threshold=-1.0, delete_notes=False)
    low, high, count = done.notes.agg(F.min("pitch"), F.max("pitch"), F.count("*")).first()
    assert 21 <= low and high <= 108 and count == len(notes)
    assert done.sequences.filter("seq_id = 'empty'").count() == 1
    assert augment.augment_audit(seqs, threshold=-1.0, delete_notes=False).first()["skipped_invalid_range"] == 1


def test_equal_bounds_give_that_amount(spark):
    seqs = seqset(spark, [n("a", 0, 1, 60)])
    done = augment.augment_transpose(seqs, threshold=-1.0, min_transpose_amount=3, max_transpose_amount=3)
    assert rows(done.notes, "pitch") == [(63,)]


def test_appended_copies_and_dropped_sequences(spark):
    seqs = seqset(spark, [n("a", 0, 1, 60), n("b", 0, 1, 108)])
    options = {"threshold": -1.0, "min_transpose_amount": 3, "max_transpose_amount": 3, "in_place": False}
    done = augment.augment_transpose(seqs, **options)
    assert rows(done.notes, "pitch", "seq_id") == [(60, "a"), (63, "a#transposed")]
    assert {r[0] for r in rows(done.sequences, "seq_id")} == {"a", "a#transposed"}
    audit = augment.augment_audit(seqs, **options).first()
    assert (audit["input_sequences"], audit["output_sequences"], audit["skipped_due_to_range_exceeded"]) == (2, 2, 1)
    in_place = augment.augment_transpose(seqs, **{**options, "in_place": True})
    assert rows(in_place.notes, "seq_id", "pitch") == [("a", 63)]
    assert rows(in_place.sequences, "seq_id") == [("a",)]


def test_splits_cover_and_do_not_depend_on_partitions(spark):
    ratios = {"train": 0.7, "validation": 0.2, "test": 0.1}
    ids = spark.range(5000).selectExpr("cast(id as string) as seq_id")
    chosen = ids.select("seq_id", augment.split_of(ratios, F.col("seq_id")).alias("split"))
    again = ids.repartition(7).select("seq_id", augment.split_of(ratios, F.col("seq_id")).alias("split"))
    assert chosen.exceptAll(again).count() == 0
    shares = {r["split"]: r["count"] / 5000 for r in chosen.groupBy("split").count().collect()}
    assert all(abs(shares[s] - r) < 0.03 for s, r in ratios.items())
    report = rows(augment.split_report(chosen, ratios), "split", "expected")
    assert report == [("test", 500), ("train", 3500), ("validation", 1000)]


@pytest.mark.parametrize("ratios", [{"a": 1.0}, {"a": 0.5, "b": 0.4}, {"a": 1.5, "b": -0.5}])
def test_bad_ratios(ratios):
    with pytest.raises(ValueError):
        augment.check_ratios(ratios)


# Represent


@pytest.mark.parametrize("mode", ["windows", "blocks"])
def test_encode_and_decode(spark, request, mode):
    if mode == "blocks":
        request.getfixturevalue("blocked")
    seqs = grid(spark, [n("a", 1, 4, 60), n("a", 3, 5, 62), n("a", 7, 9, 64)], total_steps=10)
    tokens = [129, 60, 128, 62, 128, 129, 129, 64, 128, 129]
    assert represent.encode(seqs).first()["pitch_seq"] == tokens
    assert represent.encode(seqs, length=12).first()["pitch_seq"] == tokens + [129, 129]
    assert represent.encode(seqs, length=4).first()["pitch_seq"] == tokens
    notes = [(1, 3, 60), (3, 5, 62), (7, 9, 64)]
    assert rows(represent.decode(represent.encode(seqs)), "q_start", "q_end", "pitch") == notes


def test_long_sequences_continue_in_chunks(spark):
    """All chunks are stored, the silent one too, and a note over borders comes back as one."""
    seqs = grid(spark, [n("a", 1, 7, 60), n("a", 7, 8, 62), n("a", 14, 15, 64)], total_steps=17)
    chunks = represent.encode(seqs, chunk_steps=4)
    assert [(r["chunk"], r["held"], r["pitch_seq"]) for r in chunks.orderBy("chunk").collect()] == [
        (0, None, [129, 60, 128, 128]),
        (1, 60, [128, 128, 128, 62]),
        (2, None, [129, 129, 129, 129]),
        (3, None, [129, 129, 64, 129]),
        (4, None, [129]),
    ]
    notes = [(1, 7, 60), (7, 8, 62), (14, 15, 64)]
    for size in (1, 2, 3, 4, 5, 16, 17, 100):
        again = represent.decode(represent.encode(seqs, chunk_steps=size), chunk_steps=size)
        assert sorted(rows(again, "q_start", "q_end", "pitch")) == notes
    assert represent.fixed_length(chunks, 17)[0].count() == 5
    assert {r["actual_length"] for r in represent.fixed_length(chunks, 4)[1].collect()} == {17}
    with pytest.raises(ValueError):
        represent.decode(chunks)


def test_sequences_in_chunks_are_compared_as_wholes(spark):
    seqs = grid(spark, [n("a", 0, 1, 60), n("a", 6, 7, 64), n("b", 0, 1, 61), n("b", 6, 7, 64), n("c", 0, 1, 60), n("c", 6, 7, 64)])
    kept = distinct.distinct_examples(represent.encode(seqs, chunk_steps=4)).collect()
    assert sorted((r["seq_id"], r["chunk"], r["copies"]) for r in kept) == [("a", 0, 2), ("a", 1, 2), ("b", 0, 1), ("b", 1, 1)]


def test_parse_selects_and_fills(spark):
    seqs = attributes.compute_attributes(grid(spark, [n("a", 0, 1, 60), n("a", 1, 2, 65)]), ["contour"])
    examples = represent.encode_with_context(seqs, ["contour"])
    assert represent.parse(examples).columns == ["seq_id"]
    parsed = represent.parse(examples, ["toussaint", "contour", "other"], 0.5, parse_sequence_feature=True)
    assert parsed.columns == ["seq_id", "toussaint", "contour", "pitch_seq"]
    assert parsed.first()["toussaint"] == 0.5
    with pytest.raises(Exception, match="has no default"):
        represent.parse(examples, ["toussaint"]).collect()
    fits, others = represent.fixed_length(examples, 2)
    assert (fits.count(), others.count()) == (1, 0)


# Distinct


def test_distinct_by_record_and_by_content(spark):
    notes = [n("a", 0, 1, 60, idx=0), n("a", 1, 2, 62, idx=1), n("b", 1, 2, 62, idx=0), n("b", 0, 1, 60, idx=1), n("c", 0, 1, 60)]
    seqs = seqset(spark, notes)
    twice = seqs.with_(sequences=seqs.sequences.union(seqs.sequences), notes=seqs.notes.union(seqs.notes))
    record = distinct.distinct_sequences(twice)
    assert (record.sequences.count(), record.notes.count()) == (3, 5)
    content = distinct.distinct_sequences(record, "content")
    assert rows(content.sequences, "seq_id") == [("a",), ("c",)]
    assert content.notes.count() == 3
    again = distinct.distinct_sequences(content, "content")
    assert rows(again.sequences, "seq_id") == rows(content.sequences, "seq_id")
    with pytest.raises(ValueError):
        distinct.distinct_sequences(seqs, "names")


def test_histogram_edges(spark):
    table = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (None,)], "contour double")
    assert rows(hist.histogram(table, ["contour"], [2]), "bin", "count") == [(0, 2), (1, 2)]
    with pytest.raises(ValueError):
        hist.histogram(table, ["colour"])
