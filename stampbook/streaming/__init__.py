from stampbook.streaming.activity_stream import daily_activity, day_counts, recounted_days, stream_into

__all__ = ["daily_activity", "day_counts", "recounted_days", "stream_into"]
