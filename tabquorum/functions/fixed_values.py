"""The constants results depend on, stated plainly."""

# Honorifics and what each is recoded to; others are kept.
TITLE_RECODE = {
    "Don": "Rare", "Countess": "Rare", "Col": "Rare", "Rev": "Rare", "Lady": "Rare",
    "Mme": "Mrs", "Capt": "Rare", "Dr": "Rare", "Sir": "Rare", "Jonkheer": "Rare",
    "Mlle": "Miss", "Major": "Rare", "Ms": "Miss",
}

# Integer codes of the map-based string encoding.
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5, "null": 6}
SEX_CODES = {"female": 1, "male": 0, "null": 2}
EMBARKED_CODES = {"C": 1, "S": 0, "Q": 2}

# Right-closed band edges.
AGE_EDGES = (16, 32, 48, 64)
FARE_EDGES = (7.91, 14.454, 31)
OVERALL_EDGES = (74, 83)

# Port used where none is recorded.
DEFAULT_PORT = "S"

# Passenger columns and types.
PASSENGER_FIELDS = (
    ("PassengerId", "int"), ("Survived", "int"), ("Pclass", "int"), ("Name", "string"),
    ("Sex", "string"), ("Age", "float"), ("SibSp", "int"), ("Parch", "int"),
    ("Ticket", "string"), ("Fare", "float"), ("Cabin", "string"), ("Embarked", "string"),
)
PASSENGER_FEATURES = ("Pclass", "Age", "Sex_indexed", "Fare", "Embarked_indexed",
                      "Title_indexed", "Alone", "Age*Class")

# Player skill columns, all int.
PLAYER_SKILLS = (
    "Acceleration", "Aggression", "Agility", "Balance", "Ball control", "Composure", "Crossing",
    "Curve", "Dribbling", "Finishing", "Free kick accuracy", "GK diving", "GK handling",
    "GK kicking", "GK positioning", "GK reflexes", "Heading accuracy", "Interceptions", "Jumping",
    "Long passing", "Long shots", "Marking", "Penalties", "Positioning", "Reactions",
    "Short passing", "Shot power", "Sliding tackle", "Sprint speed", "Stamina", "Standing tackle",
    "Strength", "Vision", "Volleys",
)
