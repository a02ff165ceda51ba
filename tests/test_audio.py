import numpy as np
import pytest

from batchlens.operators.audio import prepare_audio, prepare_blocks, resample

SCHEMA = "file_ids long, sampling_rate int, samples array<float>"


def tone(rate, seconds=0.2, pitch=440.0):
    return np.sin(2 * np.pi * pitch * np.arange(int(rate * seconds)) / rate)


@pytest.mark.parametrize("rate", [8000, 11025, 22050, 44100, 48000])
def test_a_tone_stays_the_same_tone(rate):
    out = resample(tone(rate), rate)
    want = tone(16000)
    assert len(out) == len(want)
    inner = slice(200, -200)
    assert np.abs(out[inner] - want[inner]).max() < 0.01


def test_too_high_a_pitch_is_filtered_out():
    out = resample(tone(44100, pitch=12000.0), 44100)
    assert np.abs(out[200:-200]).max() < 0.05


def test_lengths_and_short_signals():
    for n in (0, 1, 2, 5, 441, 442):
        assert len(resample(np.ones(n), 44100)) == -(-n * 160 // 441)


def test_rows_are_checked_not_failed(spark):
    data = [
        (1, 16000, [0.5, -0.5]),
        (2, 8000, [0.0] * 4),
        (3, 0, [1.0]),
        (4, None, [1.0]),
        (5, 8000, None),
        (6, 8000, []),
    ]
    out = {r.file_ids: r for r in prepare_audio(spark.createDataFrame(data, SCHEMA)).collect()}
    assert out[1].samples == [0.5, -0.5] and out[1].problem is None
    assert out[2].samples == [0.0] * 8 and out[2].sampling_rate == 16000
    assert out[3].problem == out[4].problem == "no sampling rate"
    assert out[5].problem == "no samples" and out[5].samples is None
    assert out[3].samples is None and out[6].samples == []


def test_more_channels_are_refused(spark):
    df = spark.createDataFrame([(1, 8000, [[1.0]])], "f long, sampling_rate int, samples array<array<float>>")
    with pytest.raises(ValueError, match="single-channel"):
        prepare_audio(df)


def test_long_recording_in_blocks_is_the_whole(spark):
    rng = np.random.default_rng(3)
    data = [(r, r, [float(x) for x in rng.standard_normal(int(3.4 * r))]) for r in (4000, 16000, 22050, 44100)]
    data += [(1, 16000, None), (2, 8000, [0.5, None]), (3, 8000, []), (4, None, [1.0])]
    df = spark.createDataFrame(data, "file_ids long, sampling_rate int, samples array<float>")
    whole = {r.file_ids: (r.samples, r.problem) for r in prepare_audio(df).collect()}
    blocks = {}
    for r in prepare_blocks(df, seconds=1).orderBy("file_ids", "block").collect():
        samples, problem = blocks.setdefault(r.file_ids, ([], r.problem))
        assert r.problem == problem and (r.samples is None or r.first_sample == len(samples))
        samples.extend(r.samples or [])
    assert {k: p for k, (_, p) in blocks.items()} == {k: p for k, (_, p) in whole.items()}
    assert blocks[2][1] == "missing samples"
    for key, (samples, _) in whole.items():
        assert len(blocks[key][0]) == len(samples or [])
        assert np.allclose(blocks[key][0], samples or [], atol=1e-12)
