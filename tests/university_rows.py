"""A small university in the feed layouts.  All rows are invented for these tests."""

from __future__ import annotations

import csv
from pathlib import Path

# number, department, cohort year, province, status
STUDENTS = [
    (1, 1, 2019, "TP HCM", "Active"),
    (2, 1, 2019, "Ha Noi", "Graduated"),
    (3, 1, 2022, "Ha Noi", "Active"),
    (4, 2, 2019, "TP HCM", "Graduated"),
    (5, 2, 2021, "Ha Noi", "Active"),
    (6, 2, 2021, "Ha Noi", "Dropped"),
    (7, 2, 2022, "TP HCM", "Active"),
    (8, 4, 2019, "Ha Noi", "Dropped"),
    (9, 4, 2021, "Ha Noi", "Active"),
    (10, 4, 2021, "Ha Noi", "Graduated"),
    (11, 5, 2022, "TP HCM", "Active"),
    (12, 5, 2022, "Ha Noi", "Active"),
]

# student, course, semester, letter, total score, absences out of 40 sessions
ENROLLMENTS = [
    (1, "LOG10", "2019F", "B", "7.1", 4),
    (1, "ALG10", "2019F", "A", "9.0", 0),
    (1, "ALG20", "2022F", "C+", "6.4", 10),
    (2, "LOG10", "2019F", "C", "5.5", 8),
    (2, "ALG20", "2021S", "B+", "8.1", 2),
    (3, "LOG10", "2022F", "A", "9.4", 1),
    (4, "ART10", "2019F", "B+", "8.4", 0),
    (4, "ART20", "2021S", "B", "7.5", 6),
    (5, "ART10", "2021F", "C+", "6.6", 5),
    (5, "LOG10", "2021F", "B", "7.7", 3),
    (6, "ART10", "2021F", "C", "5.1", 12),
    (7, "ART10", "2022F", "A", "8.9", 2),
    (8, "BIO10", "2019F", "C", "5.9", 20),
    (9, "BIO10", "2021F", "B", "7.2", 4),
    (9, "BIO20", "2022F", "B+", "8.2", 0),
    (10, "BIO10", "2021F", "A", "9.9", 0),
    (11, "LAW10", "2022F", "B", "7.0", 7),
    (12, "LAW10", "2022F", "C+", "6.9", 9),
]
POINTS = {"A": 4.0, "B+": 3.3, "B": 3.0, "C+": 2.3, "C": 2.0}

# course, department
COURSES = [
    ("LOG10", 1), ("ALG10", 1), ("ALG20", 1), ("ART10", 2), ("ART20", 2),
    ("BIO10", 4), ("BIO20", 4), ("LAW10", 5), ("LAW20", 5),
]

# student, semester, tuition, scholarship, discount, paid, day
TUITION = [
    (1, "2021S", "900.00", "100.00", "0.00", "800.00", "2021-02-10"),
    (4, "2021S", "1200.00", "0.00", "60.00", "1140.00", "2021-02-11"),
    (5, "2021F", "1200.00", "300.00", "0.00", "900.00", "2021-09-05"),
    (9, "2021F", "1500.00", "0.00", "0.00", "1500.00", "2021-09-06"),
]


def semester_start(code: str) -> str:
    return f"{code[:4]}-{'09' if code.endswith('F') else '02'}-01"


def students() -> list[dict]:
    out = []
    for number, department, cohort, province, status in STUDENTS:
        out.append(
            {
                "student_id": f"P{number:03d}",
                "first_name": f" Given{number}",
                "last_name": f"Family{number} ",
                "date_of_birth": f"{2000 + number % 4}-{1 + number % 12:02d}-{1 + number:02d}",
                "gender": ["Male", "nữ"][number % 2],
                "email": f"Student{number}@University.example",
                "phone": f"090 {number:07d}",
                "address": f"{number} Main Street",
                "city": "Town",
                "province": province,
                "cohort_year": cohort,
                "department_id": f"DEPT{department:03d}",
                "enrollment_date": f"{cohort}-09-01",
                "status": status,
            }
        )
    return out


def departments() -> list[dict]:
    return [
        {
            "department_id": f"DEPT{n:03d}",
            "department_name": f"Department {n}",
            "faculty": f" Faculty {n % 3}",
            "dean_name": f"Dean {n}",
            "established_year": 1984 + n,
        }
        for n in range(1, 7)
    ]


def semesters() -> list[dict]:
    codes = [f"{y}{half}" for y in range(2019, 2024) for half in ("S", "F")]
    return [
        {
            "semester_id": f"SEM{code}",
            "semester_name": f"Term {code}",
            "academic_year": int(code[:4]) - (code[4] == "S"),
            "semester_number": 2 if code[4] == "S" else 1,
            "start_date": semester_start(code),
            "end_date": f"{code[:4]}-06-15" if code[4] == "S" else f"{int(code[:4]) + 1}-01-15",
            "is_current": str(code == "2023F").lower(),
        }
        for code in codes
    ]


def courses() -> list[dict]:
    return [
        {
            "course_id": code,
            "course_name": f"Course {code}",
            "course_description": "",
            "credits": 2 if code.endswith("20") else 3,
            "department_id": f"DEPT{department:03d}",
            "course_level": "Undergraduate",
            "course_type": "Required",
            "is_active": "true",
        }
        for code, department in COURSES
    ]


def enrollments() -> list[dict]:
    out = []
    for number, (student, course, semester, letter, score, absent) in enumerate(ENROLLMENTS, 1):
        out.append(
            {
                "enrollment_id": f"ENR{number:03d}",
                "student_id": f"P{student:03d}",
                "course_id": course,
                "semester_id": f"SEM{semester}",
                "enrollment_date": semester_start(semester),
                "midterm_score": score,
                "final_score": score,
                "total_score": score,
                "grade_letter": letter,
                "status": "Completed",
                "attendance_count": 40 - absent,
                "absence_count": absent,
            }
        )
    return out


def tuition() -> list[dict]:
    names = "tuition_amount scholarship_amount discount_amount paid_amount payment_date".split()
    return [
        {
            "transaction_id": f"TXN{n:03d}",
            "student_id": f"P{row[0]:03d}",
            "semester_id": f"SEM{row[1]}",
            **dict(zip(names, row[2:])),
            "payment_method": "Cash",
            "status": "Paid",
        }
        for n, row in enumerate(TUITION, 1)
    ]


FEEDS = {f.__name__: f for f in (departments, semesters, courses, students, enrollments, tuition)}


def write_csv(path: Path, records: list[dict]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, records[0].keys())
        writer.writeheader()
        writer.writerows(records)


def write_feeds(folder: Path, **changed: list[dict]) -> dict[str, tuple[str, str]]:
    """All feeds as CSV files; ``changed`` replaces the rows of single feeds."""
    feeds = {}
    for name, build in FEEDS.items():
        write_csv(folder / f"{name}.csv", changed.get(name) or build())
        feeds[name] = (str(folder / f"{name}.csv"), "csv")
    return feeds
