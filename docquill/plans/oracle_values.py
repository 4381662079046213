"""Values that the DuckDB SQL is written with, stated here by themselves so that a change in the library shows as a difference."""

# Patterns of refusals and vague answers, in the order that decides.
REFUSAL_PATTERNS = {'insufficient_context': ['no\\s+(?:sufficient|enough)\\s+(?:information|evidence|context)',
                          "(?:the\\s+)?context\\s+(?:does\\s+not|doesn't|has\\s+no)\\s+(?:contain|provide|include)",
                          'not\\s+(?:mentioned|specified|provided|included)\\s+in\\s+(?:the\\s+)?(?:context|document)',
                          "(?:the\\s+)?(?:provided|given)\\s+context\\s+(?:does\\s+not|doesn't)",
                          'insufficient\\s+(?:information|context|data)',
                          '(?:the\\s+)?context\\s+(?:is\\s+)?(?:unclear|incomplete|lacks)',
                          'no\\s+relevant\\s+(?:information|context|data)',
                          "based\\s+on\\s+(?:the\\s+)?(?:provided|given)\\s+context,?\\s+(?:i\\s+)?(?:cannot|can't)",
                          "(?:the\\s+)?document\\s+(?:does\\s+not|doesn't)\\s+(?:mention|specify|provide)",
                          'not\\s+enough\\s+(?:information|context|evidence)'],
 'ambiguous_question': ['(?:your\\s+)?question\\s+(?:is\\s+)?(?:unclear|ambiguous|vague)',
                        '(?:could\\s+you|please)\\s+(?:clarify|rephrase|be\\s+more\\s+specific)',
                        '(?:i\\s+)?(?:need|require)\\s+(?:more\\s+)?(?:clarification|details)',
                        'what\\s+(?:do\\s+you\\s+mean|are\\s+you\\s+asking)',
                        "(?:not\\s+)?(?:sure|certain)\\s+(?:what\\s+you're|what\\s+you\\s+are)\\s+asking"],
 'out_of_scope': ["(?:that's|that\\s+is)\\s+(?:outside|beyond)\\s+(?:my\\s+)?(?:scope|expertise|knowledge)",
                  "(?:i\\s+)?(?:cannot|can't)\\s+(?:help|assist)\\s+with\\s+(?:that|this)",
                  "(?:i'm|i\\s+am)\\s+(?:only|specifically)\\s+(?:designed|trained)\\s+(?:for|to)",
                  '(?:not\\s+)?(?:related\\s+to|about)\\s+(?:GDPR|data\\s+protection)',
                  '(?:outside|beyond)\\s+(?:the\\s+)?(?:scope\\s+of|domain\\s+of)'],
 'capability_limitation': ["(?:i\\s+)?(?:cannot|can't|unable\\s+to)\\s+(?:access|retrieve|search)",
                           "(?:i\\s+)?(?:don't|do\\s+not)\\s+have\\s+(?:access|permission|ability)",
                           '(?:that\\s+)?(?:requires|needs)\\s+(?:external|real-time)\\s+(?:access|data)',
                           "(?:i\\s+)?(?:cannot|can't)\\s+(?:browse|fetch|query)\\s+(?:external|live)"]}
VAGUE_PATTERNS = ['^(?:yes|no|maybe|unclear|unknown)\\.?$',
 "^(?:i\\s+)?(?:don't|do\\s+not)\\s+know\\.?$",
 '^not\\s+(?:sure|certain|available)\\.?$']
# Words that are no keywords.
STOP_WORDS = ['what',
 'when',
 'where',
 'which',
 'should',
 'would',
 'could',
 'does',
 'have',
 'about',
 'under',
 'their',
 'there',
 'these',
 'those',
 'with',
 'from',
 'into',
 'that',
 'this']
# Routing patterns, quotes, phrases and warning of the question answering.
ROUTES = {'policy': '\\b(?:polic(?:y|ies)|procedures?|retain(?:ed)?|retention|how '
           'long|internal|guidelines?|operational|forgotten|erasure)\\b',
 'legislation': '\\b(?:articles?|regulations?|laws?|legal|legislation|statut(?:e|es|ory)|requirements?|rights?)\\b',
 'fines': '\\b(?:fines?|fined|penalt(?:y|ies)|enforcement|sanctions?|companies)\\b'}
QUOTES = {'policy': ('[SOURCE: Internal Retail Policy | Section: ', True),
 'legislation': ('[SOURCE: GDPR Legislation | Article: ', True),
 'fines': ('[SOURCE: Enforcement History & Fines Precedent', False)}
EXAMPLE_PHRASES = ['handle', 'approach', 'deal with', 'respond to']
INCOMPLETE_PHRASES = ['does not specify',
 'unclear from the context',
 'not provided in',
 'no information',
 'context does not',
 'insufficient information',
 'does not contain',
 'not mentioned',
 'no details']
WARNING = '**GROUNDEDNESS WARNING**: This answer may contain information not fully supported by the retrieved documents. The system attempted multiple times to generate a fully grounded response but was unable to do so. Please verify critical details with a GDPR compliance expert before taking action.\n\n    ---\n\n    '
# Questions of built cases, metrics, scores and the judge's prompt.
FALLBACK_ARTICLE = 'What are our baseline transparent communication obligations when handling requests for access to personal information details under {ctx}?'
FALLBACK_MULTI = 'What are the strict operational notification limits for security incidents, and what fines have been levied for late reports?'
FALLBACK_POLICY = 'What is our company baseline position on retention timelines for standard behavioral tracking data?'
FIRST_FINES_CONCEPT = 'largest GDPR fines'
MULTI_SUFFIX = ' compliance alignment'
METRICS = ['total_cases', 'passed', 'failed', 'pass_rate', 'avg_score', 'source_accuracy', 'content_match']
SCORES = ['relevance', 'accuracy', 'completeness', 'citation', 'clarity', 'overall']
JUDGE_TEMPLATE = 'Score the answer of an assistant to a question about data protection.\n\nQuestion: {question}\nAnswer: {answer}\nRetrieved context: {context}\n\nGive a whole number from 1 (worst) to 5 (best) for relevance, accuracy, completeness, citation,\nclarity and overall, and one sentence of explanation. Reply with one JSON object that has these\nseven keys and nothing else.\n'
# The test bed's opening sentences.
OPENINGS = ['What fines have companies received? ',
 'What does Article 17 say? ',
 'How long do we retain customer data? ',
 'Right to be forgotten requirements and penalties: ',
 '']
