"""Original report labels as an optional last projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed column labels per report, in column order.
LABELS = {
    "current_week_status": ["강의명", "현재진도(%)", "현재학습시간(분)", "현재학습", "스냅샷날짜"],
    "week_over_week": ["강의명", "이번주학습(분)", "이번주학습시간", "진도증가(%)", "현재진도(%)", "남은시간(분)"],
    "trend_4w": ["주차", "학습강의수", "누적학습시간(분)", "누적학습", "평균진도(%)"],
    "weekly_volume_4w": ["주차", "학습한강의수", "주간학습량(분)", "주간학습시간", "평균학습량(분)"],
    "course_pattern": [
        "강의명", "기록주차", "주평균학습(분)", "최대주간학습(분)", "현재진도(%)", "남은시간(분)", "남은학습시간",
    ],
    "goal_attainment": ["주차", "총학습시간(분)", "총학습", "주목표(분)", "목표달성률(%)", "상태"],
    "completion_forecast": ["강의명", "현재진도(%)", "남은시간(분)", "주평균학습(분)", "완강예상주차", "예상완강일"],
    "snapshot_history": ["날짜", "강의명", "진도율", "학습시간", "총시간", "기록시각"],
    "idle_courses": ["강의명", "진도율", "남은시간(분)", "마지막학습주차"],
    "completed_today": ["강의명", "섹션", "강의", "강의시간(분)", "완료시각"],
    "completed_today_stats": ["완료한_강의수", "총_학습시간(분)", "총_학습시간(시간)"],
    "completed_today_by_course": ["강의명", "오늘_완료한_강의수", "학습시간(분)", "학습시간(시간)"],
    "completed_last_7d": ["날짜", "강의명", "섹션", "강의", "강의시간(분)"],
    "daily_stats_7d": ["날짜", "요일", "완료_강의수", "학습시간(분)", "학습시간(시간)"],
    "completed_on": ["강의명", "섹션", "강의", "강의시간(분)", "완료시각"],
    "month_stats": ["완료_강의수", "총_학습시간(분)", "총_학습시간(시간)", "하루평균_강의수"],
    "recent_completed": ["강의명", "섹션", "강의", "완료일", "강의시간(분)"],
    "today_vs_yesterday": ["구분", "완료_강의수", "학습시간(시간)"],
    "weekday_pattern_30d": ["요일", "평균_완료_강의수", "평균_강의시간(분)"],
}


def with_labels(df: DataFrame, report: str) -> DataFrame:
    """The report with its original column labels."""
    return df.toDF(*LABELS[report])
