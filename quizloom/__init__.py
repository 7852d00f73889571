"""quizloom: question-corpus analytics and text-corpus operators on Spark DataFrames."""
