from datetime import datetime

DAY = datetime(2024, 1, 10)


def at(hour: int, minute: int = 0) -> datetime:
    return datetime(2024, 1, 10, hour, minute)


def collected(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
