from screenrank.streaming.recommender import current_recs, score_events  # noqa: F401
