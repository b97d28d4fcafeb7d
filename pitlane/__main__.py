from pitlane.plans.pipeline import main

main()
