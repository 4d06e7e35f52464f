"""Fixed schemas of the tables; an empty input gives an empty table of the same schema."""

NOTES = "song_id string, stem string, instrument_index int, instrument_name string, program int, is_drum boolean, pitch int, velocity int, start_s double, end_s double, dur_s double"
EVENTS = NOTES + ", beat_index bigint, bar_index bigint, beat_in_bar double, start_beat_float double, end_beat_float double"
BEATS = "song_id string, stem string, beat_index bigint, time_s double, tempo_bpm double"
BAR_GRID = "song_id string, bar_index bigint, start_s double, end_s double"
BARS = "song_id string, stem string, bar_index bigint, num_notes bigint, mean_velocity double, pitch_min int, pitch_max int, start_s double, end_s double"
BAR_FEATURES = (
    "song_id string, stem string, bar_index bigint, start_s double, end_s double, duration_s double, tempo_bpm double, rms double, zcr double, energy double, "
    "spectral_centroid_mean double, spectral_centroid_std double, spectral_rolloff_mean double, spectral_rolloff_std double, spectral_bandwidth_mean double, "
    "mfcc_mean array<double>, mfcc_std array<double>, chroma_mean array<double>, chunk_path string, audio_source string"
)
SIGNAL = "song_id string, stem string, sample_rate int, samples array<float>, error string"
NODES = "id string, type string, name string, file string, lineno int, doc string"
EDGES = "source string, target string, type string, detail string"
