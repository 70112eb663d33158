"""Code tables that must equal the published ones for right results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Activity code of food and carbohydrate entries.
MEAL_ACTIVITY = {
    1: "BeforeBreakfast",
    2: "AfterBreakfast",
    3: "BeforeLunch",
    4: "AfterLunch",
    5: "BeforeDinner",
    6: "AfterDinner",
    7: "Bedtime",
    8: "BeforeExercise",
    9: "AfterExercise",
    12: "Snack",
    14: "Fasting",
}

# Activity code of exercise entries (spelling and code 31 differ from meals).
EXERCISE_ACTIVITY = {
    1: "BeforeBreakFast",
    2: "AfterBreakFast",
    3: "BeforeLunch",
    4: "AfterLunch",
    5: "BeforeDinner",
    6: "AfterDinner",
    7: "Bedtime",
    8: "BeforeExercise",
    9: "AfterExercise",
    12: "Snack",
    14: "Fasting",
    31: "JustChecking",
}

# Exercise intensity; 0 and unknown codes are null.
EXERCISE_INTENSITY = {1: "High", 2: "Moderate", 3: "Low"}

# Exercise type.
EXERCISE_TYPE = {
    1: "Cardiovascular",
    2: "StrengthTraining",
    3: "Sports",
    4: "FitnessClass",
    5: "YogaPilates",
    100: "Walking",
    101: "Running",
    102: "Hiking",
    103: "Bicycling",
    104: "Swimming",
    105: "Strength_training",
    106: "Home_activities",
    107: "Gardening__Lawn",
    108: "Dancing__Aerobics",
    109: "Skiing__Skating",
    110: "Yoga_Pilates",
    111: "Other",
}

# Engagement event name to record name.
ENGAGEMENT_RECORD = {
    "PreviewEvent": "EgmLink",
    "Prescription Order Page Loaded": "EgmAuthen",
    "Call Pharmacy": "EgmCallPharm",
    "CampaignCopayAssistanceTap": "EgmSave",
    "CampaignEducationalContentTap": "EgmLearn",
    "CampaignSchedulePickup": "EgmRmd",
    "SendInitialSMSLink": "SendSMS",
    "SendReminderSMSLink": "SendSMS",
    "SendRenewalSMSLink": "SendSMS",
}

# Nutrients summed over the items of a meal.
NUTRIENTS = [
    "Carbs",
    "Fiber",
    "Fat",
    "Calories",
    "Protein",
    "Sodium",
    "SaturatedFat",
    "PolyUnSaturatedFat",
    "MonoUnSaturatedFat",
    "TransFat",
    "Cholesterol",
    "Potassium",
    "Sugar",
    "AddedSugars",
]

# Message actions and the drug names watched by each model family.
MESSAGE_ACTIONS = ["Default", "Save", "Pickup Reminder", "Education"]
MODEL_DRUGS = {
    "jardiance": ["Jardiance"],
    "stiolto": ["Stiolto respimat"],
    "quviviq": ["Quviviq"],
}


def lookup(col: Column, table: dict) -> Column:
    """Value of a small fixed table for a key; null when the key is absent."""
    entries = [F.lit(x) for kv in table.items() for x in kv]
    return F.create_map(*entries)[col]
